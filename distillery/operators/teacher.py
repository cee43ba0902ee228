"""Teacher / student scoring surfaces.

* Native (default): teacher output that arrives as a table -- vectors joined by key
  (cosine per pair) or yes/no log-probability maps (log-odds per pair).
* Pluggable batch scorers: ``mapInPandas`` over Arrow batches. A scorer is any
  ``Iterator[pd.DataFrame] -> Iterator[pd.DataFrame]``; model state loads once per task
  (or once per Python worker through a module-level cache) and batches stream through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distillery.functions.numeric import fix9
from distillery.functions.scoring import MISSING_LOGPROB, NO_TOKEN, YES_TOKEN, yes_no_logit
from distillery.functions.text import ASSISTANT_SUFFIX, DEFAULT_MAX_TOKENS
from distillery.functions.vectors import COSINE_EPS, cosine, norm, to_double_array

Scorer = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def prepare_vectors(vectors: DataFrame, key_col: str, vec_col: str = "embedding") -> DataFrame:
    """``key, v array<double>, n`` -- norms computed once per vector, not per pair."""
    v = vectors.select(F.col(key_col).alias("_key"), to_double_array(vec_col).alias("_v"))
    return v.select("_key", "_v", norm("_v").alias("_n"))


def attach_vectors(df: DataFrame, vectors: DataFrame, on: str, prefix: str, how: str = "inner") -> DataFrame:
    """Equi-join a prepared vector table (see :func:`prepare_vectors`) on ``df[on]``;
    adds ``<prefix>_v`` and ``<prefix>_n``. Catalyst/AQE choose broadcast or shuffle from
    the measured size of the vector side."""
    vv = vectors.select(
        F.col("_key").alias(f"_{prefix}_key"), F.col("_v").alias(f"{prefix}_v"), F.col("_n").alias(f"{prefix}_n")
    )
    return df.join(vv, df[on] == vv[f"_{prefix}_key"], how).drop(f"_{prefix}_key")


def score_pairs_cosine(
    pairs: DataFrame, vectors: DataFrame, query_key: str, passage_key: str, out_col: str = "score",
    how: str = "inner",
) -> DataFrame:
    """Cosine of the query and passage vectors of every pair, fixed to 9 decimals.
    With ``how="left"`` pairs lacking a vector keep a NULL score (see :func:`split_missing`)."""
    with_q = attach_vectors(pairs, vectors, query_key, "q", how)
    with_p = attach_vectors(with_q, vectors, passage_key, "p", how)
    score = fix9(cosine("q_v", "p_v", "q_n", "p_n"))
    return with_p.withColumn(out_col, score).drop("q_v", "q_n", "p_v", "p_n")


def split_missing(scored: DataFrame, score_col: str) -> tuple[DataFrame, DataFrame]:
    """(scored, missing) -- rows whose score could not be computed go to the report."""
    return scored.filter(F.col(score_col).isNotNull()), scored.filter(F.col(score_col).isNull())


def teacher_from_logprobs(df: DataFrame, logprobs_col: str = "logprobs", out_col: str = "score") -> DataFrame:
    """Log-odds teacher score from yes/no log-probability maps (missing token -> -10)."""
    return df.withColumn(out_col, fix9(yes_no_logit(logprobs_col)))


# ---- pluggable batch scorers (mapInPandas) -------------------------------------------

def score_pairs(pairs: DataFrame, scorer: Scorer, out_schema: str) -> DataFrame:
    """Run a batch scorer over Arrow batches of ``pairs``. Batch size is
    ``spark.sql.execution.arrow.maxRecordsPerBatch``; order inside a batch is kept."""
    return pairs.mapInPandas(scorer, out_schema)


Tokenizer = Callable[[list[str]], list[np.ndarray]]
Teacher = Callable[[list[np.ndarray]], list[dict[str, float]]]

#: Prompts that are sorted by length together, and padded tokens that a batch may have.
SORT_ROWS, TOKEN_BUDGET = 4_096, 65_536
#: Prompts, and bytes of them, that are turned into ids at once; ids that are held for sorting.
PART_ROWS, PART_BYTES, HELD_TOKENS = 256, 1_000_000, 2_000_000


def code_point_tokenizer(texts: list[str]) -> list[np.ndarray]:
    """Token ids that are code points: a stand-in for a model's tokenizer."""
    return [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) for t in texts]


def length_batches(lengths: np.ndarray, batch_size: int, token_budget: int) -> Iterator[np.ndarray]:
    """The numbers of the prompts in batches, shortest first: at most ``batch_size`` prompts, and
    at most ``token_budget`` tokens after padding to the longest, unless one prompt alone has more."""
    order = np.argsort(lengths, kind="stable")
    start = 0
    for i in range(1, len(order) + 1):
        if i == len(order) or i - start >= batch_size or (i + 1 - start) * lengths[order[i]] > token_budget:
            yield order[start:i]
            start = i


def score_prompts(
    pairs: DataFrame, load_teacher: Callable[[], Teacher], keep_cols: Sequence[str], prompt_col: str = "prompt",
    max_length: int = DEFAULT_MAX_TOKENS, batch_size: int = 8, token_budget: int = TOKEN_BUDGET,
    tokenizer: Tokenizer = code_point_tokenizer, sort_rows: int = SORT_ROWS, out_col: str = "score",
) -> DataFrame:
    """``keep_cols``, ``n_ids`` (of the cut prompt with its suffix) and ``out_col``, the yes/no
    log-odds of a batch teacher.

    ``load_teacher`` is called once a task and gives a function from a batch of token ids to
    each prompt's log-probabilities by token. Every whole prompt is turned into ids, cut to
    ``max_length`` and followed by the assistant's suffix, which isn't cut. Within runs of
    ``sort_rows`` rows, or fewer if they have ``HELD_TOKENS`` ids, prompts are batched by length
    (see :func:`length_batches`), so that little is spent on padding. Prompts are decoded and
    turned into ids some at a time and only cut ids are held, so a task's memory is bounded,
    however many and long its prompts; rows leave in the order they came. A token without a log-probability counts as the floor."""
    if min(max_length, batch_size, token_budget, sort_rows) <= 0:
        raise ValueError("lengths and sizes must be positive")
    keep = list(keep_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        teacher, suffix = load_teacher(), tokenizer([ASSISTANT_SUFFIX])[0]

        def scored(rows: list[pa.RecordBatch], ids: list[np.ndarray]) -> pa.RecordBatch:
            lengths = np.array([len(x) for x in ids], np.int64)
            score = np.empty(len(ids))
            for some in length_batches(lengths, batch_size, token_budget):
                for i, told in zip(some, teacher([ids[i] for i in some])):
                    score[i] = told.get(YES_TOKEN, MISSING_LOGPROB) - told.get(NO_TOKEN, MISSING_LOGPROB)
            kept = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays([*kept.columns, pa.array(lengths), pa.array(_fix9_np(score))],
                                              [*kept.schema.names, "n_ids", out_col])

        held, ids, tokens = [], [], 0
        for batch in batches:
            for at, texts in _texts_in_parts(batch.column(len(keep)), min(sort_rows, PART_ROWS)):
                ids += [np.concatenate([x[:max_length], suffix]) for x in tokenizer(texts)]
                tokens += sum(map(len, ids[-len(texts):]))
                # copied: a slice would hold on to the whole batch
                held.append(batch.select(range(len(keep))).take(pa.array(range(at, at + len(texts)), pa.int64())))
                if len(ids) >= sort_rows or tokens >= HELD_TOKENS:
                    yield scored(held, ids)
                    held, ids, tokens = [], [], 0
        if ids:
            yield scored(held, ids)

    types = dict(pairs.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + ["n_ids long", f"`{out_col}` double"])
    return pairs.select(*keep, prompt_col).mapInArrow(run, schema)


def _texts_in_parts(column: pa.Array, rows: int) -> Iterator[tuple[int, list[str]]]:
    """Where each part of a text column begins, and its texts: at most ``rows`` of them, and
    ``PART_BYTES`` of text unless one alone has more."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and (i - start >= rows or total + size > PART_BYTES):
            yield start, column.slice(start, i - start).to_pylist()
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, column.slice(start).to_pylist()


def stand_in_teacher() -> Teacher:
    """A deterministic stand-in for a constrained one-token model: log-probabilities from the
    sum of the ids, the less likely token sometimes missing, as beyond the top log-probabilities."""
    def tell(batch: list[np.ndarray]) -> list[dict[str, float]]:
        out = []
        for ids in batch:
            total = int(ids.sum())
            both = {YES_TOKEN: -(total % 1201) / 100.0, NO_TOKEN: -(total % 997) / 80.0}
            out.append({k: v for k, v in both.items() if v >= -9.0})
        return out

    return tell


def _fix9_np(x: np.ndarray) -> np.ndarray:
    return np.floor(x * 1e9 + 0.5) / 1e9


def numpy_cosine_scorer(
    keep_cols: Sequence[str], q_col: str = "q_v", p_col: str = "p_v", out_col: str = "score"
) -> Scorer:
    """Batch cosine with numpy over ``array<double>`` columns (norm floor as the native
    version); emits ``keep_cols`` plus ``out_col`` fixed to 9 decimals."""
    keep = list(keep_cols)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf) == 0:
                continue
            q = np.stack(pdf[q_col].to_numpy())
            p = np.stack(pdf[p_col].to_numpy())
            dots = np.einsum("ij,ij->i", q, p)
            nq = np.maximum(np.sqrt(np.einsum("ij,ij->i", q, q)), COSINE_EPS)
            np_ = np.maximum(np.sqrt(np.einsum("ij,ij->i", p, p)), COSINE_EPS)
            out = pdf[keep].copy()
            out[out_col] = _fix9_np(dots / (nq * np_))
            yield out

    return run


def hashing_embedder(dim: int = 64, ngram: int = 3) -> Callable[[pd.Series], np.ndarray]:
    """Deterministic character n-gram hashing embedder (unit-normalised), a stand-in
    for a neural text encoder: whole texts in, ``dim`` floats out. An n-gram of the text
    between two spaces has the number ``sum(code point * 31 ** place)``; its remainder by
    ``dim`` is the entry, and the parity of its quotient the sign, with which it counts."""

    def embed(texts: pd.Series) -> np.ndarray:
        out = np.zeros((len(texts), dim))
        for i, t in enumerate(texts):
            codes = code_point_tokenizer([f" {t} "])[0]
            codes = np.pad(codes, (0, max(0, ngram - len(codes))))
            h = np.zeros(len(codes) - ngram + 1, np.int64)
            for k in range(ngram):
                h = h * 31 + codes[k:len(h) + k]
            out[i] = np.bincount(h % dim, 1 - 2 * (h // dim % 2), dim)
        n = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return (out / np.maximum(n, COSINE_EPS)).astype(np.float32)

    return embed


def embed_texts(
    texts: DataFrame, embedder: Callable[[pd.Series], np.ndarray] | None = None, text_col: str = "text",
    keep_cols: Sequence[str] = (), out_col: str = "embedding",
) -> DataFrame:
    """Embed each row's text with a batch embedder (``mapInPandas``); feed it the output of
    ``distinct_texts`` so every text is embedded once."""
    emb = embedder or hashing_embedder()
    keep = list(keep_cols) if keep_cols else [text_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf) == 0:
                continue
            vecs = emb(pdf[text_col])
            out = pdf[keep].copy()
            out[out_col] = list(vecs)
            yield out

    fields = ", ".join(f"`{c}` {dict(texts.dtypes)[c]}" for c in keep)
    return texts.select(*dict.fromkeys([*keep, text_col])).mapInPandas(run, f"{fields}, `{out_col}` array<float>")
