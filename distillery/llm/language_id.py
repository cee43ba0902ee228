"""Language identification: script ranges narrow the candidates, a Viterbi pass over
per-word scores with a switching penalty labels spans of mixed-language text.

Training (one Spark aggregation over a bounded, documented sample of labelled rows) counts
hashed character trigrams and letter scripts by language. A word's score for a language is
the sum of its trigrams' log-probabilities; languages that don't write the word's script
are out of the question for it. The model's size is fixed: languages x 65,536 numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distillery.llm.common import hand_back, in_slices, map_texts

BUCKETS = 1 << 16
#: Labelled rows to learn from, by language (expected number; whole texts).
SAMPLE_PER_LANG = 400
SWITCH_PENALTY = 6.0
MEMO_WORDS = 200_000
SCORED_WORDS = 20_000
OUT_OF_SCRIPT = -60.0

# First code points of the ranges that the writing systems occupy.
SCRIPTS = [(0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
           (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "lao"),
           (0x0F00, "tibetan"), (0x1000, "burmese"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
           (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"),
           (0x2E80, "han"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "kana"), (0x3400, "han"),
           (0xA000, "other"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"),
           (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"),
           (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han")]
_STARTS = np.array([x for x, _ in SCRIPTS], np.uint32)
_NAMES = sorted({x for _, x in SCRIPTS})
_SCRIPT_OF = np.array([_NAMES.index(x) for _, x in SCRIPTS])
_NO_LETTER = regex.compile(r"\P{L}+")
_LETTER = regex.compile(r"\p{L}")


def _trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of non-empty words: hashed trigrams (with marks for begin and end) in word order, each
    word's first place among them, and the script of each word's first letter."""
    codes = np.frombuffer(("\x02" + "\x03\x02".join(words) + "\x03").encode("utf-32-le", "surrogatepass"), "<u4")
    c = codes.astype(np.uint64)
    h = (c[:-2] * 0x9E3779B1 + c[1:-1] * 0x85EBCA77 + c[2:] * 0xC2B2AE3D) & 0xFFFFFFFF
    h = ((h ^ (h >> 15)) * 0x2C1B3C6D & 0xFFFFFFFF) >> 16
    keep = (codes[:-2] != 3) & (codes[1:-1] != 3)
    begin = np.flatnonzero(codes == 2)
    place = np.concatenate([[0], np.cumsum(keep)])[begin]
    return h[keep].astype(np.int64), place, _SCRIPT_OF[np.searchsorted(_STARTS, codes[begin + 1], "right") - 1]


def _letters(word: str) -> str:
    return word if word.isalpha() else _NO_LETTER.sub("", word)


@dataclass
class Model:
    langs: list[str]
    grams: np.ndarray  # BUCKETS x langs, log-probabilities
    scripts: np.ndarray  # scripts x langs, True where a language writes the script

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores by word and language, and whether any language writes the word's script."""
        h, place, script = _trigrams(words)
        scores = np.add.reduceat(self.grams[h], place, axis=0)
        allowed = self.scripts[script]
        # a script that no language writes tells nothing
        scores = np.where(allowed, scores - scores.max(axis=1, keepdims=True), OUT_OF_SCRIPT)
        told = allowed.any(axis=1)
        return np.where(told[:, None], scores, 0.0), told


def train(docs: DataFrame, learn_from: Column, per_lang: int = SAMPLE_PER_LANG, key: str = "doc_id",
          text: str = "text", lang: str = "lang") -> Model:
    """Learn from rows where ``learn_from`` holds and the label isn't null: all of a language's
    rows if there are few, else a sample of about ``per_lang`` by a hash of the key."""
    rows = docs.filter(learn_from & F.col(lang).isNotNull() & F.col(text).isNotNull())
    totals = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}  # one row a language
    langs = sorted(totals)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((len(_NAMES), 0), bool))
    share = F.create_map(*[F.lit(y) for x in langs for y in (x, min(1.0, per_lang / totals[x]))])
    draw = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    sample = rows.filter(draw < share[F.col(lang)]).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hand_back()
        for pdf in batches:
            for lang_, texts in pdf.groupby("lang").text:
                words = [x for t in texts for w in t.lower().split() if (x := _letters(w))]
                if words:
                    h, _, script = _trigrams(words)
                    slots = np.concatenate([h, BUCKETS + script])
                    slot, n = np.unique(slots, return_counts=True)
                    yield pd.DataFrame({"lang": lang_, "slot": slot, "n": n})

    got = sample.mapInPandas(count, "lang string, slot long, n long").groupBy("lang", "slot").agg(
        F.sum("n").alias("n")).toPandas()  # at most languages x (BUCKETS + scripts) rows
    counts = np.zeros((BUCKETS + len(_NAMES), len(langs)))
    counts[got.slot.to_numpy(int), [langs.index(x) for x in got.lang]] = got.n
    grams = counts[:BUCKETS] + 0.3
    words = counts[BUCKETS:]
    return Model(langs, np.log(grams / grams.sum(axis=0)).astype(np.float32), words >= np.maximum(1, 0.01 * words.sum(axis=0)))


def viterbi(scores: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word: texts of ``sizes`` words (all over 0), one after another,
    with ``scores`` by word and label. All texts go forward together, longest first."""
    k = scores.shape[1]
    order = np.argsort(-sizes, kind="stable")
    first = (np.cumsum(sizes) - sizes)[order]
    active = np.searchsorted(-sizes[order], -np.arange(sizes.max()), "left")  # texts with a t-th word
    back = np.empty((len(scores), k), np.int8 if k < 128 else np.int32)
    own = np.arange(k)
    state = scores[first].copy()
    for t in range(1, len(active)):
        n = active[t]
        if n < len(state):
            state_n = state[:n]
        else:
            state_n = state
        best = state_n.argmax(axis=1)
        top = state_n[np.arange(n), best][:, None] - penalty
        at = first[:n] + t
        move = top > state_n
        back[at] = np.where(move, best[:, None], own)
        state[:n] = np.maximum(state_n, top) + scores[at]
    labels = np.empty(len(scores), np.int64)
    current = state.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = first[:n] + t
        labels[at] = current[:n]
        if t:
            current[:n] = back[at, current[:n]]
    return labels


class Labeller:
    """Applies a model to texts; keeps a bounded memo of word scores."""

    def __init__(self, model: Model, penalty: float):
        self.model, self.penalty = model, penalty
        self._reset()

    def _reset(self) -> None:
        self.row: dict[str, int] = {}
        self.size = np.zeros(0, np.int32)  # letters
        self.told = np.zeros(0, bool)  # some language writes the script
        self.scores = np.zeros((0, len(self.model.langs)), np.float32)

    def _learn(self, words: list[str]) -> None:
        letters = [_letters(w) for w in words]
        size = np.fromiter(map(len, letters), np.int32, len(letters))
        scores = np.zeros((len(words), len(self.model.langs)), np.float32)
        told = np.zeros(len(words), bool)
        some = np.flatnonzero(size)
        if len(some) and self.model.langs:
            for at in range(0, len(some), SCORED_WORDS):  # trigrams by languages are held for so many words
                part = some[at:at + SCORED_WORDS]
                scores[part], told[part] = self.model.word_scores([letters[i] for i in part])
        self.row.update(zip(words, range(len(self.size), len(self.size) + len(words))))
        self.size = np.concatenate([self.size, size])
        self.told = np.concatenate([self.told, told])
        self.scores = np.concatenate([self.scores, scores])

    def label(self, texts: list[str | None], spans: bool = True) -> list[tuple[str, float, list[dict]]]:
        """Of each text: language, share of its letters so labelled, and spans of words (if asked for). Words in a
        script that no language writes count as letters, but for no language."""
        langs = self.model.langs
        words = [t.lower().split() if t is not None else [] for t in texts]
        if len(self.row) > MEMO_WORDS:
            self._reset()
        self._learn(list(set().union(*words).difference(self.row)))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        out: list = [("und", 0.0, [])] * len(texts)
        if not langs or not sizes.any():
            return out
        rows = np.fromiter(map(self.row.__getitem__, (w for x in words for w in x)), np.int64, sizes.sum())
        labels = viterbi(self.scores[rows], sizes[sizes > 0], self.penalty)
        letters = self.size[rows]
        told = letters * self.told[rows]
        end = np.cumsum(sizes)
        for i in np.flatnonzero(sizes):
            a, b = end[i] - sizes[i], end[i]
            share = np.bincount(labels[a:b], told[a:b], len(langs))
            if share.sum():
                best, runs = int(share.argmax()), []
                if spans:
                    cut = np.concatenate([[0], np.flatnonzero(np.diff(labels[a:b])) + 1, [b - a]])
                    runs = [{"lang": langs[labels[a + x]], "first_word": int(x), "n_words": int(y - x)}
                            for x, y in zip(cut, cut[1:])]
                out[i] = (langs[best], float(share[best] / letters[a:b].sum()), runs)
            elif _LETTER.search(texts[i]):
                out[i] = (langs[0], 0.0, [])
        return out


SPANS = "array<struct<lang:string,first_word:long,n_words:long>>"


def identify(docs: DataFrame, model: Model, penalty: float = SWITCH_PENALTY, text: str = "text",
             keep: list[str] | None = None, spans: bool = True, least: float | None = None) -> DataFrame:
    """The columns ``keep`` and ``lang_pred, score, spans`` of every row (without the last if ``spans``
    is false). Only the text decides. With ``least``, rows that are ``und`` or score less are left out,
    before they leave the task.

    A text that is null, empty or without a letter is ``und`` with score 0 and no spans, as
    is every text if nothing was learnt. Repeated rows are labelled alike; other columns pass
    through unseen. Words are those between white space, counted from 0.
    """
    keep = list(keep or [])
    schema = ", ".join([f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
                       + ["lang_pred string", "score double"] + [f"spans {SPANS}"] * spans)
    at = f"c{keep.index(text)}" if text in keep else "x_text"  # a text that is kept is sent once
    n = len(keep)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model, penalty)
        kinds = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())]))
        for part, texts in in_slices(batches, at):
            got = labeller.label(texts, spans)
            if least is not None:
                rows = [i for i, x in enumerate(got) if x[0] != "und" and x[1] >= least]
                part, got = part.take(pa.array(rows, pa.int64())), [got[i] for i in rows]
            columns = [pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())]
            if spans:
                columns.append(pa.array([x[2] for x in got], kinds))
            yield pa.RecordBatch.from_arrays([*part.columns[:n], *columns], [
                *part.schema.names[:n], "lang_pred", "score", *["spans"] * spans])

    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)],
                       *([] if text in keep else [F.col(text).alias("x_text")]))
    return map_texts(rows, label, schema).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score", *["spans"] * spans)


def held_out(key: str = "doc_id") -> Column:
    """True for the test rows: CRC-32 of the key as text, modulo 3, is 1. A null key is not."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))
