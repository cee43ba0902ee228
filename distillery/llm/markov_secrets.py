"""Secret scans: fixed patterns, and character Markov models that tell random strings from
ordinary identifiers by their log-likelihood ratio.

The two first-order models are trained on labelled strings of a bounded, documented sample of
documents: ordinary are the words and identifiers outside what the patterns find; random are
what they find, and, for each document, strings drawn from a digest of its key in the
alphabets that keys are written in. Only the counts of character pairs leave the tasks.

A run of key characters is searched for the part whose ratios add up to the most (a path or a
name before a key pulls nothing down), each character paying a toll; it is reported if that
is evidence enough. How long a random string has to be follows from how unlike ordinary ones
it is: there is no length, and no kind of character, below or without which none is tried.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distillery.llm.common import in_slices, map_texts

# The patterns of the known kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
ACCESS = re.compile("AKIA[A-Z0-9]{12,}")
HEX = re.compile("[0-9a-f]{32,}")
#: Characters of text that are searched together.
SCAN_CHARS = 250_000
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODE = np.full(128, -1, np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
STRETCH = re.compile("[A-Za-z0-9]+")
UUID = re.compile(r"[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}")
ORDINARY = re.compile(r"[A-Za-z_][A-Za-z0-9_-]{3,}")
#: Documents to learn from (expected number, drawn by a hash of the key; whole texts).
SAMPLE_DOCS = 20_000
#: What each character of a random part pays, and what has to be left, in nats.
TOLL, EVIDENCE = 0.3, 20.0
#: Share of the uniform distribution in either model.
BLEND = 0.01
#: Alphabets of the random strings that are drawn for training.
DRAWN = ("abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyz0123456789", "0123456789abcdef",
         "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
         "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """``start, kind, end, value start, value end`` of the fixed patterns' matches: each kind
    leftmost and non-overlapping, too short ones dropped after matching. The longest-run
    kinds need no dropping: a run that is too short holds no longer one."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end(), m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start(), m.end()) for m in ACCESS.finditer(text)]
    return sorted(out + [(m.start(), 2, m.end(), m.start(), m.end()) for m in HEX.finditer(text)])


def _pairs(words: list[str]) -> np.ndarray:
    """Counts of neighbouring characters of the alphabet, a row for the first of the two."""
    n = len(ALPHABET)
    codes = np.frombuffer("\0".join(words).encode("ascii", "replace"), np.uint8)
    codes = _CODE[np.minimum(codes, 127)]
    both = (codes[:-1] >= 0) & (codes[1:] >= 0)
    return np.bincount(codes[:-1][both] * n + codes[1:][both], minlength=n * n)


def _drawn(key: str) -> list[str]:
    """Random strings from digests of a key, one in each alphabet."""
    out = []
    for letters in DRAWN:
        data = hashlib.sha512(f"{letters}:{key}".encode()).digest()
        out.append("".join(letters[b % len(letters)] for b in data[:40]))
    return out


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """Log-likelihood ratios of character pairs (random over ordinary), alphabet x alphabet.
    Without a document both models are uniform."""
    total = docs.count()
    draw = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("secrets")), F.lit(1 << 30))
    sample = docs.filter((draw < int(min(1.0, sample_docs / max(total, 1)) * (1 << 30))) & F.col(text).isNotNull())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        random, ordinary = np.zeros(len(ALPHABET) ** 2, np.int64), np.zeros(len(ALPHABET) ** 2, np.int64)
        for pdf in batches:
            for k, t in zip(pdf.key, pdf.text):
                spans = base_spans(t)
                random += _pairs([t[s[3]:s[4]] for s in spans] + _drawn(k))
                rest, at = [], 0
                for s in spans:
                    rest.append(t[at:s[0]])
                    at = max(at, s[2])
                ordinary += _pairs(ORDINARY.findall(" ".join([*rest, t[at:]])))
        slot = np.arange(len(random))
        yield pd.DataFrame({"label": 1, "slot": slot, "n": random})[random > 0]
        yield pd.DataFrame({"label": 0, "slot": slot, "n": ordinary})[ordinary > 0]

    named = F.coalesce(F.col(key).cast("string"), F.lit(""))
    got = sample.select(named.alias("key"), F.col(text).alias("text")).mapInPandas(count, "label long, slot long, n long").groupBy(
        "label", "slot").agg(F.sum("n").alias("n")).collect()  # two tables of alphabet x alphabet at most
    n = len(ALPHABET)
    counts = np.zeros((2, n * n))
    for label, slot, k in got:
        counts[label, slot] = k
    # either model holds, for a share of the characters, any to be as likely as another: what the
    # sample of ordinary strings doesn't have is no proof of a random one
    logs = []
    for table in counts:
        table = table.reshape(n, n) + 0.5
        logs.append(np.log((1 - BLEND) * table / table.sum(axis=1, keepdims=True) + BLEND / n))
    return logs[1] - logs[0]


def random_parts(texts: list[str], blocked: list[list[tuple[int, int]]], ratios: np.ndarray, toll: float = TOLL,
                 evidence: float = EVIDENCE) -> list[list[tuple[int, int]]]:
    """Of each text the parts ``start, end`` of runs of key characters, outside ``blocked`` spans,
    whose ratios less the toll add up to ``evidence`` or more: of each run the best one. All texts
    are searched together: sums from the front, against the least sum so far within the run."""
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    codes = np.concatenate([np.frombuffer((t + "\n").encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]) if texts else np.zeros(0)
    if not len(codes):
        return out
    first = np.cumsum([0] + [len(t) + 1 for t in texts])
    codes = _CODE[np.minimum(codes, 127)]
    for begin, spans in zip(first, blocked):
        for a, b in spans:
            codes[begin + a:begin + b] = -1
    both = (codes[:-1] >= 0) & (codes[1:] >= 0)  # pair i: characters i and i + 1
    pairs = np.flatnonzero(both)
    if not len(pairs):
        return out
    gain = ratios[codes[pairs], codes[pairs + 1]] - toll
    run = np.cumsum(np.append(True, np.diff(pairs) > 1)) - 1
    starts = np.flatnonzero(np.append(True, np.diff(run) > 0))
    total = np.cumsum(gain)
    before = total - gain  # the sum up to a pair, without it
    drop = 1.0 + 2 * np.abs(gain).sum()  # runs are set apart by more than any sum
    least = np.minimum.accumulate(before - drop * run) + drop * run
    best = np.maximum.reduceat(total - least, starts)
    for r in np.flatnonzero(best >= evidence - 0.01):  # as sums over all texts are rounded, the run's own decide
        a, b = starts[r], starts[r + 1] if r + 1 < len(starts) else len(pairs)
        total = np.cumsum(gain[a:b])
        before = np.append(0.0, total[:-1])
        end = int((total - np.minimum.accumulate(before)).argmax())
        start = int(before[:end + 1].argmin())
        if total[end] - before[start] >= evidence:
            i = int(np.searchsorted(first, pairs[a + start], "right")) - 1
            out[i].append((int(pairs[a + start] - first[i]), int(pairs[a + end] + 2 - first[i])))
    return out


def scan_all(texts: list[str], ratios: np.ndarray, toll: float = TOLL, evidence: float = EVIDENCE) -> list[list[tuple[int, int, int]]]:
    """Of each text ``start, kind, end`` of all spans: the patterns', and random parts outside them.
    A part is reported with the letters and digits that it is written together with; one that is
    a UUID is an ordinary identifier."""
    base = [[s[:3] for s in base_spans(t)] for t in texts]
    parts = random_parts(texts, [[(a, b) for a, _, b in spans] for spans in base], ratios, toll, evidence)
    out = []
    for t, spans, found in zip(texts, base, parts):
        uuids = [m.span() for m in UUID.finditer(t)] if found else []
        whole = {_whole(t, a, b, spans) for a, b in found if not any(x <= a and b <= y for x, y in uuids)}
        out.append(sorted(spans + [(a, 3, b) for a, b in whole]))
    return out


def _whole(text: str, start: int, end: int, base: list[tuple[int, int, int]]) -> tuple[int, int]:
    """The part from the first to the last stretch of letters and digits of which it has half or
    more, up to spans of the patterns."""
    left = max((b for _, _, b in base if b <= start), default=0)
    right = min((a for a, _, _ in base if a >= end), default=len(text))
    first, last = start, end
    while first > left and STRETCH.fullmatch(text[first - 1]):
        first -= 1
    while last < right and STRETCH.fullmatch(text[last]):
        last += 1
    most = [m.span() for m in STRETCH.finditer(text, first, last)]
    most = [(a, b) for a, b in most if 2 * (min(b, end) - max(a, start)) >= b - a]
    return (most[0][0], most[-1][1]) if most else (start, end)


def scan(text: str, ratios: np.ndarray, toll: float = TOLL, evidence: float = EVIDENCE) -> list[tuple[int, int, int]]:
    """:func:`scan_all` of one text."""
    return scan_all([text], ratios, toll, evidence)[0]


def find_secrets(docs: DataFrame, ratios: np.ndarray, toll: float = TOLL, evidence: float = EVIDENCE,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_assign, n_access, n_hex, base_sha256, spans`` of every row.

    Spans are ``kind:start:end`` in code points, end exclusive, by start, then kind. A null text
    is empty: no spans, the digest of the empty string. Repeated rows and null keys are kept.
    """
    kind = docs.schema[key].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in in_slices(batches, chars=SCAN_CHARS):
            counts, digests, spans = [], [], []
            for found in scan_all([t or "" for t in texts], ratios, toll, evidence):
                base = [s for s in found if s[1] < 3]
                counts.append([sum(s[1] == k for s in base) for k in range(3)])
                digests.append(hashlib.sha256(_said(base).encode()).hexdigest())
                spans.append(_said(found))
            columns = list(zip(*counts)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *[pa.array(c, pa.int64()) for c in columns], pa.array(digests, pa.string()),
                 pa.array(spans, pa.string())], ["key", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return map_texts(rows, find, f"key {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, "
                                 "spans string").withColumnRenamed("key", key)


def _said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
