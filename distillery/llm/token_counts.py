"""Exact token counts of whole texts, by overlap resynchronisation for huge documents.

A tokenizer's library encodes a whole text at once, in memory that grows with it. Here a
long text is encoded in overlapping chunks with offsets. Two neighbouring chunks are
spliced at a *stable common boundary*: a position inside their overlap at which both
encodings break and at which the tokenizer provably breaks whatever stands around it. If
the overlap has none, it is doubled, up to the whole chunk; then the two chunks are encoded
as one.

Proof of the boundary: let position p follow a character that isn't white space (Unicode
White_Space) and precede one that is. In both supported pre-tokenizers (byte-level with its
own pattern; the lower-casing word pattern) white space can only begin a match, or fill it,
so no match crosses p; patterns look ahead by one character only across white space, so the
matches before p depend on the text before p alone and those after it on the text after it
alone. NFC doesn't compose across white space, and a special string without white space
never contains p. The same fact lets short texts be counted as a sum over the pieces
between stable boundaries, each distinct piece being encoded once (bounded memo). Pieces also
end between a Latin letter or digit and a stop (.,;:!?): in both patterns letters, digits and
other signs are matched apart, only an apostrophe joins them, and a stop composes with nothing
before it. Where the normalizer lower-cases, Latin texts are lowered before they are cut,
unless that would make a special string. A new piece of Latin letters alone, or of a space and
such letters (where white space is dropped, a line break too), is a single match of either pattern that no normalizer changes, so its byte
characters go straight to the library's merge model; other pieces pass the whole tokenizer.

A tokenizer for which this isn't proven is applied to whole texts.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distillery.llm.common import in_slices, map_texts

# The code points with the Unicode property White_Space.
WHITE = "\t-\r\x20\x85\xa0  -     　"
# Letters and digits of ASCII and Latin-1; punctuation that no contraction begins with.
ALNUM, STOPS = "0-9A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?"
PIECE = re.compile(f"[{WHITE}]*+[^{WHITE}{STOPS}]++(?<=[{ALNUM}])(?=[{STOPS}])|[{WHITE}]*+[^{WHITE}]++|[{WHITE}]++")
SPACES = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{WHITE}]", c))
# what a lower-casing normalizer and Python's lower() agree on, one code point for one
FOLDABLE = re.compile("[^\\x00-\\xff–—‘’“”…•€]")
STABLE = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")
# pieces that are one match: of any letters, and of those that lower-casing leaves alone
LETTERS, LOWERED = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+"), re.compile("[ \\n]?[a-zß-öø-ÿ]+")


def _byte_characters() -> dict[int, str]:
    """For each Latin-1 code point, the characters by which byte-level models write its UTF-8
    bytes: printable bytes stand for themselves, the others follow from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    of = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: "".join(of[b] for b in chr(c).encode()) for c in range(256)}


BYTE_CHARACTERS = _byte_characters()

CHUNK_CHARS = 65_536
OVERLAP_CHARS = 256
MEMO_PIECES = 400_000
MEMO_PIECE_CHARS = 64


def _proven(path: str) -> bool:
    """True if the file's pre-tokenizer and normalizer are those of the proof above."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    for token in spec.get("added_tokens") or []:
        if token["lstrip"] or token["rstrip"] or token["single_word"] or re.search(f"[{WHITE}]", token["content"]):
            return False
    if spec.get("post_processor") or spec.get("truncation") or spec.get("padding"):
        return False
    normal, before = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
    if before.get("type") == "ByteLevel":
        return normal is None and before["use_regex"] and not before["add_prefix_space"]
    if before.get("type") != "Sequence" or [x["type"] for x in before["pretokenizers"]] != ["Split", "ByteLevel"]:
        return False
    split, level = before["pretokenizers"]
    steps = [x["type"] for x in (normal or {}).get("normalizers", [])]
    return (split["invert"] and split["behavior"] == "Removed" and not level["use_regex"]
            and not level["add_prefix_space"] and steps == ["NFC", "Replace", "Lowercase"]
            and "\\s" in split["pattern"].get("Regex", ""))


class Encoder:
    """A public tokenizer by file: ``.json`` for tokenizers, ``.model`` for sentencepiece. With
    ``plain``, special strings inside texts are ordinary text."""

    def __init__(self, path: str, plain: bool = False):
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.ids = lambda texts: model.encode(texts, num_threads=1)
            self.proven = False
            return
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        model.encode_special_tokens = plain
        self.model = model
        self.ids = lambda texts: [x.ids for x in model.encode_batch(texts, add_special_tokens=False)]
        self.spans = lambda text: model.encode(text, add_special_tokens=False)
        self.proven = _proven(path)
        self.special = [] if plain else [x.content for x in model.get_added_tokens_decoder().values()]
        self.lowers = self.proven and model.normalizer is not None
        merges, self.single = model.model, LOWERED if self.lowers else LETTERS
        if type(merges).__name__ != "BPE" or any(LETTERS.fullmatch(x) for x in self.special):
            self.single = re.compile("(?!)")  # no piece goes straight to the model

        def merged(piece: str) -> list[int]:
            if self.lowers:  # this pattern drops white space
                piece = piece.lstrip(" \n")
            if not (self.lowers and piece.isascii()):
                piece = piece.translate(BYTE_CHARACTERS)
            return [x.id for x in merges.tokenize(piece)]

        self.merged = merged

    def folded(self, text: str) -> str:
        """The text, lowered where that can't change its ids."""
        if not self.lowers or not text.isascii() and FOLDABLE.search(text):
            return text
        low = text.lower()
        return text if any(x in low for x in self.special) else low


def spliced(encoder: Encoder, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS,
            found: list | None = None) -> list[int]:
    """Ids of a long text from overlapping chunks. ``found`` gathers the splice positions."""
    out: list[int] = []
    left, end, width = 0, min(chunk, len(text)), overlap
    a = encoder.spans(text[:end])
    base = 0  # where the text of encoding a begins
    while True:
        if end == len(text):
            out += [i for i, (s, _) in zip(a.ids, a.offsets) if base + s >= left]
            return out
        start = max(left, end - width)
        if start > left:
            stop = min(start + chunk, len(text)) if start + chunk > end else min(end + chunk, len(text))
            b = encoder.spans(text[start:stop])
            p = _common(text, a.offsets, base, b.offsets, start, end)
            if p is not None:
                out += [i for i, (s, _) in zip(a.ids, a.offsets) if left <= base + s < p]
                if found is not None:
                    found.append(p)
                left, base, end, a, width = p, start, stop, b, overlap
                continue
            width *= 2
            continue
        # the overlap has reached the last splice: encode both chunks as one
        end = min(end + max(chunk, end - left), len(text))
        base, a, width = left, encoder.spans(text[left:end]), overlap


def _common(text: str, a: list, a_base: int, b: list, b_base: int, end: int) -> int | None:
    """The last stable position in the overlap [b_base, end) that no token of either crosses."""
    stable = [m.start() for m in STABLE.finditer(text, b_base + 1, end)]
    for p in reversed(stable):
        if p < end and not any(s + a_base < p < e + a_base for s, e in a[-4 * (end - b_base) - 8:]) \
                and not any(s + b_base < p < e + b_base for s, e in b[:4 * (end - b_base) + 8]):
            return p
    return None


class Counter:
    """Counts or encodes texts; keeps a bounded memo of short pieces. The library keeps a cache for
    each tokenizer and thread that has used it, about 5 MB, until the thread ends: the calls have a
    thread of their own, so that a worker doesn't gather the caches of all its tasks."""

    def __init__(self, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS, memo_pieces: int | None = None,
                 plain: bool = False):
        self.encoder, self.chunk, self.overlap = Encoder(path, plain), chunk, overlap
        self.memo_pieces = MEMO_PIECES if memo_pieces is None else memo_pieces
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the memo before: what is asked for again moves on
        self.thread = ThreadPoolExecutor(1)

    def __getstate__(self) -> dict:  # a process that has counted may send this package's functions
        return self.__dict__ | {"thread": None}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ = state | {"thread": ThreadPoolExecutor(1)}

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, pieces: set[str]) -> None:
        """Encode new pieces, many at a time: a piece that begins with white space (as the
        pre-tokenizers know it: Python's ``isspace`` counts more) may follow any that doesn't end
        with it, as a stable boundary lies between them."""
        single, merged, pack = self.encoder.single.fullmatch, self.encoder.merged, self.pack
        straight = [p for p in pieces if single(p)]
        self.memo.update((p, pack(merged(p))) for p in straight)
        pieces = pieces.difference(straight)
        joined = [p for p in pieces if p[0] in SPACES and p[-1] not in SPACES and len(p) <= MEMO_PIECE_CHARS]
        alone = list(pieces.difference(joined))
        for p, ids in zip(alone, self.encoder.ids(alone)):
            self.memo[p] = pack(ids)
        for i in range(0, len(joined), 256):
            some = joined[i:i + 256]
            got = self.encoder.spans("".join(some))
            ids = np.array(got.ids, "<u4").tobytes()
            starts = np.fromiter((s for s, _ in got.offsets), np.int64, len(got.ids))
            ends = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)))
            cuts = [0, *(4 * np.searchsorted(starts, ends)).tolist()]
            self.memo.update((p, ids[x:y]) for p, x, y in zip(some, cuts, cuts[1:]))

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        return self.thread.submit(self._ids, texts).result()

    def _ids(self, texts: list[str | None]) -> list[bytes]:
        if not self.encoder.proven:
            return [np.array(x, "<u4").tobytes() for x in self.encoder.ids([t or "" for t in texts])]
        if len(self.memo) > self.memo_pieces // 2:
            self.memo, self.older = {}, self.memo
        memo, older = self.memo, self.older
        fold = self.encoder.folded
        cut = [None if t is not None and len(t) > self.chunk else PIECE.findall(fold(t or "")) for t in texts]
        # each piece is looked up once; only the new ones, a few of each text, again
        got = [x and list(map(memo.get, x)) for x in cut]
        gaps = [x and [i for i, known in enumerate(x) if known is None] for x in got]
        new = {x[i] for x, at in zip(cut, gaps) if at for i in at}
        known = {p: older[p] for p in new if p in older}
        memo.update(known)
        new.difference_update(known)
        self._learn(new)
        out = []
        for text, pieces, ids, at in zip(texts, cut, got, gaps):
            if pieces is None:
                out.append(np.array(spliced(self.encoder, text, self.chunk, self.overlap), "<u4").tobytes())
                continue
            for i in at:
                ids[i] = memo[pieces[i]]
            out.append(b"".join(ids))
        for p in new:
            if len(p) > MEMO_PIECE_CHARS:
                del memo[p]
        return out

    def forget(self) -> None:
        """Drop the memo and let go of the tokenizer, as a task does at its end: a later task has its
        own copy, and an idle worker would keep this one beside those of other stages. The thread
        ends, and the library's cache with it."""
        self.memo, self.older = {}, {}
        self.thread.shutdown()
        self.thread = ThreadPoolExecutor(1)
        for key in [k for k, counter in _counters.items() if counter is self]:
            del _counters[key]

    def counts(self, texts: list[str | None]) -> list[int]:
        return [len(x) // 4 for x in self.ids(texts)]


_counters: dict[tuple, Counter] = {}


def worker_counter(path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS,
                   memo_pieces: int | None = None, plain: bool = False) -> Counter:
    """The counter of this task's functions (a task gets its own copy of the package, by value),
    until it is told to forget."""
    key = path, chunk, overlap, memo_pieces, plain
    if key not in _counters:
        _counters[key] = Counter(*key)
    return _counters[key]


def token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 512, key: str = "doc_id",
                 text: str = "text", chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, one row for one row.

    A null text counts as empty: 0 bytes, 0 tokens. Null keys, repeated rows and ties are
    kept as they are; other columns aren't read. An empty table gives an empty result.
    """
    path = public_tokenizers.path(tokenizer)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_counter(path, chunk, overlap)
        for part, texts in in_slices(batches):
            n = pa.array(counter.counts(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), n], ["key", "n_bytes", "n_tokens"])
        counter.forget()

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
                       F.col(text).alias("text"))
    return map_texts(rows, count, f"key {kind}, n_bytes long, n_tokens long").select(
        F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
