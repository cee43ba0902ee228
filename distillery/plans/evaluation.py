"""Before/after rank evaluation as one grouped job.

Judged candidates (one row per query x candidate with a binary ``rel``) are scored by each
model; the report is grouped by (domain, model) in one pass instead of one sequential pass
per evaluation, then the runs are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distillery.functions.vectors import COSINE_EPS
from distillery.operators import metrics, report

PairScorer = Callable[[pd.Series, pd.Series], np.ndarray]


def judged_from_samples(samples: DataFrame, domain: str | None = None) -> DataFrame:
    """Judged candidates of JSONL samples: ``qid`` = the sample (file and position),
    ``seq`` = candidate order inside it (positives first, list order), ``rel`` from the
    side the passage came from. The evaluation group is one sample, i.e. one input
    record, so its size is bounded by a record."""
    from distillery.plans.reranker import sample_pairs

    p = sample_pairs(samples)
    dom = F.lit(domain) if domain is not None else F.col("source_file")
    qid = F.concat_ws(":", F.col("source_file"), F.col("seq.block").cast("string"), F.col("seq.row").cast("string"))
    side = F.when(F.col("side") == "positive", F.lit(0)).otherwise(F.lit(1)).cast("long")
    return p.select(
        qid.alias("qid"), dom.alias("domain"), "query", "passage", "rel",
        (side * F.lit(1 << 32) + F.col("pos")).alias("seq"),
    )


def bi_encoder_scorer(embed: Callable[[pd.Series], np.ndarray]) -> PairScorer:
    """Cosine of query and passage embeddings (a bi-encoder student)."""

    def score(queries: pd.Series, passages: pd.Series) -> np.ndarray:
        q, p = embed(queries).astype(np.float64), embed(passages).astype(np.float64)
        nq = np.maximum(np.linalg.norm(q, axis=1), COSINE_EPS)
        np_ = np.maximum(np.linalg.norm(p, axis=1), COSINE_EPS)
        return np.einsum("ij,ij->i", q, p) / (nq * np_)

    return score


def score_with_models(
    judged: DataFrame, scorers: Mapping[str, PairScorer], keys: Sequence[str] = ("qid", "seq"),
    query_col: str = "query", passage_col: str = "passage",
) -> DataFrame:
    """Score every judged candidate with every model in one ``mapInPandas`` pass (each
    model is applied batch by batch; a model object is built once per task by its
    scorer factory), then attach the scores back to the candidates by key."""
    keys = list(keys)
    names = list(scorers)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf) == 0:
                continue
            out = pdf[keys].copy()
            for name in names:
                out[name] = np.asarray(scorers[name](pdf[query_col], pdf[passage_col]), dtype=np.float64)
            yield out

    types = dict(judged.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in keys] + [f"`{n}` double" for n in names])
    scores = judged.select(*keys, query_col, passage_col).mapInPandas(run, schema)
    return metrics.score_candidates(judged, scores, keys)


def score_inline(
    df: DataFrame, scorers: Mapping[str, PairScorer], keep: Sequence[str],
    query_col: str = "query", passage_col: str = "passage",
) -> DataFrame:
    """Like :func:`score_with_models`, when every needed column can ride through the
    Arrow batches: ``keep`` columns plus one score column per model, one pass, no join."""
    keep = list(keep)
    names = list(scorers)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf) == 0:
                continue
            out = pdf[keep].copy()
            for name in names:
                out[name] = np.asarray(scorers[name](pdf[query_col], pdf[passage_col]), dtype=np.float64)
            yield out

    types = dict(df.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in keep] + [f"`{n}` double" for n in names])
    cols = list(dict.fromkeys([*keep, query_col, passage_col]))
    return df.select(*cols).mapInPandas(run, schema)


def evaluation_report(
    judged: DataFrame, models: Sequence[str] = ("before", "after"), k: int = 10, empty_side: str = "drop",
    zero_base: str = "inf", style: str = "reranker",
) -> tuple[DataFrame, DataFrame]:
    """``(metrics_long, comparison)`` for judged candidates carrying one score column per model."""
    rep = metrics.rerank_report(judged, models, k=k, empty_side=empty_side)
    cmp = report.format_report(report.compare_runs(rep, models[0], models[1], zero_base=zero_base), style)
    return rep, cmp


def evaluate_files(
    spark, inputs, scorers: Mapping[str, PairScorer], domain: str | None = None, k: int = 10,
    empty_side: str = "zero", zero_base: str = "inf", style: str = "reranker",
):
    """Evaluation over sample files: every model scores every candidate once (one Arrow
    pass), metrics per (domain, model) in one grouped job, then the before/after
    comparison of the first two models. ``domain`` defaults to the input file."""
    from distillery.sources import jsonl

    samples = jsonl.read_samples(spark, inputs, mode="strict")
    judged = score_inline(judged_from_samples(samples, domain), scorers, ["qid", "domain", "rel", "seq"])
    return evaluation_report(judged, list(scorers), k=k, empty_side=empty_side, zero_base=zero_base, style=style)
