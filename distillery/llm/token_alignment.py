"""Alignment of two tokenizers' tokens by byte offsets, with corpus-wide counts of linked ids.

A batch's tokens of both sides are tables of byte offsets by document. ``merge_asof``, keyed by
document, finds for each token start the other side's covering token; the union of both
directions is the pairs of overlapping tokens, and equal ends cut the tokens into groups.

How many documents hold a pair of ids needs the whole corpus. Documents are gathered in
blocks of a bounded amount of text; a block keeps each distinct pair once, and each
document's pairs as positions in that list. Only the blocks' distinct pairs are shuffled to
be counted, and the counts come back to the blocks they are asked for: each task sees a block
and the counts of that block's pairs, whatever the number of pairs in the corpus.

An executor's memory doesn't grow with the input either: a document is a row of its own and a
block's list is cut into short rows, so that no reader, sort or writer holds blocks; texts come
to Python in batches of a few MB, and a task remembers fewer pieces than those that only count.

Very long texts are cut where both tokenizers provably break: before a space or line break
that follows another character than white space (see ``token_counts``; on the piece side, no
piece of the vocabulary has a space after another character, or a line break at all).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from distillery.llm.common import in_slices, map_texts, stored
from distillery.llm.token_counts import BYTE_CHARACTERS, WHITE, worker_counter

#: Characters of a text that are aligned at once, and of a block of documents.
PART_CHARS, BLOCK_CHARS = 400_000, 4_000_000
#: What a document adds to its block beside its characters; the pairs in a row of a block's list.
ROW_CHARS, ROW_PAIRS = 100, 8_192
#: Bytes of an Arrow batch of texts on its way to Python (a longer text has its own), and the
#: pieces a task remembers: two tokenizers and pandas stand beside the memo here.
BATCH_BYTES, MEMO_PIECES = 4_000_000, 200_000
CUT = re.compile(f"(?<=[^{WHITE}])(?=[ \\n])")
SPACE = "▁"
FIGURES = ["n_a", "n_b", "n_groups", "n_links"]


class Side:
    """One tokenizer: ids of texts, and each id's bytes."""

    def __init__(self, size: int, data: list[bytes], last: bytes):
        self.data = data
        self.sizes = np.array([len(x) for x in data], np.int64)
        self.blob, self.place = np.frombuffer(b"".join(data), np.uint8), np.cumsum(self.sizes) - self.sizes
        self.said = np.array([b"%d," % i for i in range(size)], object)
        self.said_last = np.array([b"%d%c" % (i, last) for i in range(size)], object)


    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The tokens' bytes, one after another."""
        sizes = self.sizes[ids]
        start = np.cumsum(sizes) - sizes
        return self.blob[np.repeat(self.place[ids] - start, sizes) + np.arange(sizes.sum())]


class ByteSide(Side):
    """A byte-level tokenizer of ``tokenizers``; a text is encoded with a space before it."""

    def __init__(self, path: str):
        self.counter = worker_counter(path, memo_pieces=MEMO_PIECES, plain=True)
        vocabulary = self.counter.encoder.model.get_vocab()
        of = {shown: c for c, shown in BYTE_CHARACTERS.items() if c < 0x80}
        of |= {chr(c): c for c in (*range(0xA1, 0xAD), *range(0xAE, 0x100))}
        hidden = [b for b in range(256) if not (0x21 <= b < 0x7F or 0xA1 <= b < 0xAD or 0xAE <= b)]
        of |= {chr(256 + i): b for i, b in enumerate(hidden)}
        data = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            data[i] = bytes(of[c] for c in entry) if all(c in of for c in entry) else entry.encode()
        super().__init__(len(data), data, b"|")

    def ids(self, parts: list[str], first: list[bool]) -> list[np.ndarray]:
        return [np.frombuffer(x, "<u4").astype(np.int64) for x in self.counter.ids([" " * f + t for t, f in zip(parts, first)])]


class PieceSide(Side):
    """A sentencepiece model, which puts a space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        data = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode()
                for i, p in enumerate(pieces)]
        super().__init__(len(data), data, b";")
        self.lead = self.model.encode("\n")  # what a line break before a text adds to its ids
        self.cuts = (len(self.lead) == 2 and self.model.is_byte(self.lead[1]) and data[self.lead[0]] == b" "
                     and not any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces))

    def ids(self, parts: list[str], first: list[bool]) -> list[np.ndarray]:
        got = self.model.encode([t if f else "\n" + t for t, f in zip(parts, first)], num_threads=1)
        return [np.array(x if f else x[2:], np.int64) for x, f in zip(got, first)]


def cut_text(text: str, size: int) -> list[str]:
    """The text in parts of about ``size`` characters or more, cut where both sides break."""
    out, at = [], 0
    while len(text) - at > size:
        m = CUT.search(text, at + size)
        if not m:
            break
        out.append(text[at:m.start()])
        at = m.start()
    return [*out, text[at:]]


def covering(starts: np.ndarray, document: np.ndarray, other: np.ndarray, other_document: np.ndarray) -> np.ndarray:
    """For each token start (offsets in the batch, ascending) the number of the covering token
    of the other side, by an as-of merge within documents."""
    tokens = pd.DataFrame({"at": starts, "document": document})
    others = pd.DataFrame({"at": other, "document": other_document, "token": np.arange(len(other))})
    return pd.merge_asof(tokens, others, on="at", by="document").token.to_numpy(np.int64)


class Aligner:
    """Aligns batches of texts."""

    def __init__(self, a: ByteSide, b: PieceSide, part_chars: int = PART_CHARS):
        self.a, self.b, self.part_chars = a, b, part_chars

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of each text ``n_a, n_b, n_groups, n_links`` and the groups' digest; and of all texts'
        distinct pairs the text's number, the pair (A id x B ids + B id) and how often it occurs."""
        figures = np.zeros((len(texts), 4), np.int64)
        digests = [hashlib.sha256() for _ in texts]
        owner, parts, first = [], [], []
        for i, t in enumerate(texts):
            if t:
                some = cut_text(t, self.part_chars) if self.b.cuts else [t]
                owner += [i] * len(some)
                parts += some
                first += [True] + [False] * (len(some) - 1)
        sound = np.zeros(len(texts), bool)
        sound[owner] = True
        keys, size = [], 0
        begin = 0
        for i, p in enumerate(parts):
            size += len(p)
            if i + 1 == len(parts) or size + len(parts[i + 1]) > self.part_chars:
                self._batch(owner[begin:i + 1], parts[begin:i + 1], first[begin:i + 1], figures, digests, sound, keys)
                begin, size = i + 1, 0
        figures[~sound] = 0
        said = [d.hexdigest() if s else "" for d, s in zip(digests, sound)]
        text = np.concatenate([k[0] for k in keys]) if keys else np.zeros(0, np.int64)
        pair = np.concatenate([k[1] for k in keys]) if keys else np.zeros(0, np.int64)
        times = np.concatenate([k[2] for k in keys]) if keys else np.zeros(0, np.int64)
        keep = sound[text]
        text, pair, times = text[keep], pair[keep], times[keep]
        if len(parts) > len(set(owner)):  # a text of several parts may hold a pair in more than one
            order = np.lexsort((pair, text))
            text, pair, times = text[order], pair[order], times[order]
            new = np.flatnonzero(np.append(True, (np.diff(text) != 0) | (np.diff(pair) != 0))[:len(text)])
            text, pair, times = text[new], pair[new], np.add.reduceat(times, new) if len(new) else times
        return figures, said, text, pair, times

    def _batch(self, owner, parts, first, figures, digests, sound, keys) -> None:
        a, b = self.a, self.b
        ids_a, ids_b = a.ids(parts, first), b.ids(parts, first)
        good = []
        for i, (x, y, t, f) in enumerate(zip(ids_a, ids_b, parts, first)):
            want = np.frombuffer((" " * f + t).encode("utf-8", "surrogatepass"), np.uint8)
            if np.array_equal(a.joined(x), want) and np.array_equal(b.joined(y), want):
                good.append(i)
            else:
                sound[owner[i]] = False
        if not good:
            return
        n_a, n_b = (np.array([len(ids[i]) for i in good]) for ids in (ids_a, ids_b))
        ids_a, ids_b = (np.concatenate([ids[i] for i in good]) for ids in (ids_a, ids_b))
        part_a, part_b = np.repeat(np.arange(len(good)), n_a), np.repeat(np.arange(len(good)), n_b)
        end_a, end_b = np.cumsum(a.sizes[ids_a]), np.cumsum(b.sizes[ids_b])
        start_a, start_b = end_a - a.sizes[ids_a], end_b - b.sizes[ids_b]
        over_a = covering(start_a, part_a, start_b, part_b)  # the B token over each A token's start
        over_b = covering(start_b, part_b, start_a, part_a)
        new = np.flatnonzero(start_a[over_b] != start_b)  # equal starts are found in both directions
        link_a = np.concatenate([np.arange(len(ids_a)), over_b[new]])
        link_b = np.concatenate([over_a, new])
        # groups: tokens up to a common end
        ends = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        last_a, last_b = ends[group_a] == end_a, ends[group_b] == end_b
        said = np.empty(len(ids_a) + len(ids_b), object)
        said[np.arange(len(ids_a)) + np.searchsorted(group_b, group_a, "left")] = np.where(
            last_a, a.said_last[ids_a], a.said[ids_a])
        said[np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")] = np.where(
            last_b, b.said_last[ids_b], b.said[ids_b])
        n_links = np.bincount(part_a[link_a], minlength=len(good))
        n_groups = np.bincount(part_a[last_a], minlength=len(good))
        owners = np.array([owner[i] for i in good])
        at = 0
        for k, i in enumerate(good):
            stop = at + n_a[k] + n_b[k]
            line = b"".join(said[at:stop])[:-1]
            digests[owner[i]].update(line if first[i] else b";" + line)
            at = stop
        np.add.at(figures, owners, np.stack([n_a, n_b, n_groups, n_links], axis=1))
        many = len(b.data)
        span = len(a.data) * many
        key, times = np.unique(part_a[link_a] * span + ids_a[link_a] * many + ids_b[link_b], return_counts=True)
        keys.append((owners[key // span], key % span, times))


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Texts run in here come to Python in batches of about ``size`` bytes, not of 10,000 rows."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def align(docs: DataFrame, byte_tokenizer: str = "byte_bpe_50k.json", piece_tokenizer: str = "piece_bpe_32k.model",
          key: str = "doc_id", text: str = "text", part_chars: int = PART_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    A is the byte-level tokenizer on a space and the text, B the piece model on the text;
    special strings inside texts are plain text. A text that is null or empty, or whose tokens'
    bytes aren't the space and the text (as where it holds the piece model's own space sign),
    has no tokens: zeros, and an empty digest. A pair of ids counts once for each row that
    holds it linked, so repeated rows count each; null keys are kept, other columns aren't read.
    An empty table gives an empty result.
    """
    path_a, path_b = public_tokenizers.path(byte_tokenizer), public_tokenizers.path(piece_tokenizer)
    kind = docs.schema[key].dataType.simpleString()
    block = (f"block long, key {kind}, n_a long, n_b long, n_groups long, n_links long, digest string, spots array<int>, "
             "times array<int>, first int, pairs array<long>, docs array<int>")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner = Aligner(ByteSide(path_a), PieceSide(path_b), part_chars)
        number = TaskContext.get().partitionId() << 32
        held, chars = [], 0
        for part, texts in in_slices(batches):
            size = sum(len(t or "") + ROW_CHARS for t in texts)
            if held and chars + size > block_chars:
                yield from _block(number, held)
                number, held, chars = number + 1, [], 0
            keys = part.column(0).take(pa.array(range(len(texts))))  # a slice would keep the batch and its texts
            held.append((keys, *aligner(texts)))
            chars += size
        if held:
            yield from _block(number, held)
        aligner.a.counter.forget()

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    with batches_of(docs.sparkSession, BATCH_BYTES):
        blocks = stored(map_texts(rows, gather, block))
    many = PieceSide(path_b).model.get_piece_size()
    asked = blocks.where("first IS NOT NULL").select(
        "block", "first", F.posexplode(F.arrays_zip("pairs", "docs")).alias("spot", "x")).select(
        "block", (F.col("first") + F.col("spot")).alias("spot"), "x.pairs", "x.docs")
    counts = stored(asked.groupBy("pairs").agg(F.sum("docs").alias("n")))
    id_a = F.floor(F.col("pairs") / many)
    most = counts.groupBy(id_a.alias("id_a")).agg(F.max("n").alias("most"))
    counts = counts.withColumn("id_a", id_a).join(most, "id_a").select("pairs", "n", (F.col("n") == F.col("most")).alias("best"))
    told = asked.select(F.col("block").alias("asker"), "spot", "pairs").join(counts, "pairs").select("asker", "spot", "n", "best")
    out = f"key {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def finish(rows: pa.Table, told: pa.Table) -> pa.Table:
        count, best = np.zeros(told.num_rows, np.int64), np.zeros(told.num_rows, np.int64)  # each spot is told once
        spot = told.column("spot").to_numpy()
        count[spot], best[spot] = told.column("n").to_numpy(), told.column("best").to_numpy()
        sizes = pa.compute.list_value_length(rows.column("spots")).to_numpy()
        spots, times = (pa.compute.list_flatten(rows.column(c)).to_numpy().astype(np.int64) for c in ("spots", "times"))
        upto = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        sums = [np.diff(np.concatenate([[0], np.cumsum(times * x[spots])])[upto]) for x in (best, count)]
        return pa.table([*rows.select(["key", *FIGURES]).columns, *map(pa.array, sums), rows.column("digest")],
                        ["key", *FIGURES, "n_best", "count_sum", "groups_sha256"])

    documents = blocks.where("first IS NULL").drop("first", "pairs", "docs")
    return documents.groupBy("block").cogroup(told.groupBy("asker")).applyInArrow(finish, out).withColumnRenamed("key", key)


def _block(number: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
    """The block's rows: its documents, with where they hold its distinct pairs, and the list of these."""
    keys = pa.concat_arrays([h[0] for h in held])
    figures, base, text, pair = [], 0, [], []
    for h in held:
        figures.append(h[1])
        text.append(h[3] + base)
        pair.append(h[4])
        base += len(h[0])
    text, pair, times = np.concatenate(text), np.concatenate(pair), np.concatenate([h[5] for h in held])
    order = np.argsort(text, kind="stable")
    text, pair, times = text[order], pair[order], times[order]
    pairs, spots, docs = np.unique(pair, return_inverse=True, return_counts=True)
    upto = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(keys)))])
    lists = lambda values, at, kind: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind))
    spots, times = lists(spots, upto, pa.int32()), lists(times, upto, pa.int32())
    first = np.arange(0, len(pairs), ROW_PAIRS)
    at = np.append(first, len(pairs))
    pairs, docs = lists(pairs, at, pa.int64()), lists(docs, at, pa.int32())
    n, m = len(keys), len(first)
    none = lambda kind, size=m: pa.nulls(size, kind)
    names = ["block", "key", *FIGURES, "digest", "spots", "times", "first", "pairs", "docs"]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, number)), keys, *map(pa.array, np.concatenate(figures).T), pa.array([s for h in held for s in h[2]], pa.string()),
         spots, times, none(pa.int32(), n), none(pairs.type, n), none(docs.type, n)], names)
    if m:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(m, number)), none(keys.type), *[none(pa.int64())] * 4, none(pa.string()), none(spots.type), none(times.type),
             pa.array(first, pa.int32()), pairs, docs], names)
