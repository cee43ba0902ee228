"""Ranking metrics per query (AP, RR@k, NDCG@k) and their means per (domain, model).

Tie handling follows the usual library semantics: candidates with equal score form one
threshold for AP (cumulative counts over a RANGE frame, whose peers are exactly the tie
group); for NDCG tied candidates share their mean gain; RR uses the first relevant
candidate in (score desc, input order) order. Binary relevance, log2 discount.

All windows partition by the same key (the query inside its domain/model) and share one
sort, so the plan has one exchange and one sort for all of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from distillery.operators.mining import quarantine_scores
from distillery.operators.skew import hot_keys, with_parts

METRIC_NAMES = ("map", "mrr@10", "ndcg@10")
#: Levels of a query that one range should hold, and ranges that are cut from one sample.
RANGE_LEVELS, SPLITTER_SAMPLE = 20_000, 16
#: Ranges of one query at most: beyond them, ranges hold more levels each.
MAX_RANGES = 256


def _log2(col):
    return F.log(col) / F.lit(math.log(2.0))


def per_query_metrics(
    judged: DataFrame,
    group_cols: Sequence[str],
    score_col: str = "score",
    rel_col: str = "rel",
    order_col: str = "seq",
    k: int = 10,
    empty_side: str = "drop",
    method: str = "window",
    range_levels: int = RANGE_LEVELS,
) -> DataFrame:
    """``*group_cols, n_cand, n_rel, ap, rr, ndcg`` -- one row per query.

    ``empty_side="drop"``: queries without a relevant or without an irrelevant candidate
    are left out (bi-encoder evaluation). ``"zero"``: kept; a query without a relevant
    candidate scores 0 on every metric (cross-encoder evaluation).

    ``method="window"`` (default): one exchange, one sort; a query's candidates are
    ranked inside one task, which suits evaluation groups that are one input sample.
    ``method="split"``: no window ever holds a whole query (see :func:`_split_metrics`),
    for judged sets where one query may carry a large share of all rows; ``range_levels``
    is the number of distinct scores that one range of a query should hold.

    NULL and NaN scores can't be ranked: as in mining, those candidates are left out before
    anything is counted, in both methods (:func:`mining.quarantine_scores` returns them).
    """
    judged, _ = quarantine_scores(judged, score_col)
    if empty_side not in ("drop", "zero"):
        raise ValueError("empty_side must be 'drop' or 'zero'")
    if method == "split":
        out = _split_metrics(judged, list(group_cols), score_col, rel_col, order_col, k, range_levels)
        return _finish(out, list(group_cols), empty_side)
    if method != "window":
        raise ValueError("method must be 'window' or 'split'")
    g = list(group_cols)
    score, rel = F.col(score_col), F.col(rel_col)
    # one partitioning, one sort: (score desc, order) serves the row numbers, and its
    # score-desc prefix serves the RANGE frames (cumulative counts; tie-group peers)
    w_rank = Window.partitionBy(*g).orderBy(score.desc(), F.col(order_col).asc())
    w_peer = Window.partitionBy(*g).orderBy(score.desc())
    w_cum = w_peer.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    w_tie = w_peer.rangeBetween(Window.currentRow, Window.currentRow)
    a = judged.select(
        *g,
        rel.alias("_rel"),
        F.row_number().over(w_rank).alias("_rn"),
        F.sum(rel).over(w_cum).alias("_cr"),
        F.count(F.lit(1)).over(w_cum).alias("_cn"),
        F.avg(rel).over(w_tie).alias("_g"),
    )
    r, rn = F.col("_rel"), F.col("_rn")
    n_rel = F.sum(r)
    ap = F.sum(F.when(r == 1, F.col("_cr").cast("double") / F.col("_cn")).otherwise(F.lit(0.0))) / F.nullif(
        n_rel.cast("double"), F.lit(0.0)
    )
    rr = F.coalesce(F.max(F.when((r == 1) & (rn <= k), F.lit(1.0) / rn)), F.lit(0.0))
    dcg = F.sum(F.when(rn <= k, F.col("_g") / _log2(rn + 1)).otherwise(F.lit(0.0)))
    per_q = a.groupBy(*g).agg(
        F.count(F.lit(1)).alias("n_cand"),
        n_rel.cast("long").alias("n_rel"),
        ap.alias("ap"),
        rr.alias("rr"),
        dcg.alias("_dcg"),
    )
    out = per_q.select(*g, "n_cand", "n_rel", "ap", "rr", (F.col("_dcg") / _ideal_dcg("n_rel", k)).alias("ndcg"))
    return _finish(out, g, empty_side)


def _ideal_dcg(n_rel_col: str, k: int):
    """Ideal DCG with binary gains, closed-form in the number of relevant candidates:
    ``sum_{i=1..min(n_rel, k)} 1 / log2(i + 1)`` (NULL when there is none)."""
    ideal = F.aggregate(
        F.sequence(F.lit(1), F.least(F.col(n_rel_col).cast("int"), F.lit(k))),
        F.lit(0.0),
        lambda acc, i: acc + F.lit(1.0) / _log2(i + 1),
    )
    return F.when(F.col(n_rel_col) > 0, ideal)


def _ranges(levels: DataFrame, g: list[str], range_levels: int) -> DataFrame:
    """``levels`` with ``_b``: the score range of the query that a level lies in, from 0, the lowest.

    A query with more than ``range_levels`` levels is cut at quantiles of a sample of its own
    scores (about ``SPLITTER_SAMPLE`` for each range, drawn by a hash of the score), so ranges
    hold about as many levels each wherever the scores lie. The draw, and with it the ranges, is
    the same whenever it is repeated; any splitters give the same metrics."""
    hot = hot_keys(levels, g, range_levels)
    sized = with_parts(levels, hot, g)
    n = F.col("_parts").cast("long")
    keep = F.pmod(F.xxhash64(F.col("_s"), F.lit("splitters")), F.lit(range_levels)) < SPLITTER_SAMPLE
    drawn = sized.filter((n > 1) & keep).groupBy(*g).agg(F.sort_array(F.collect_list("_s")).alias("_sample"))
    step = F.greatest(F.lit(SPLITTER_SAMPLE), F.ceil(F.size("_sample") / MAX_RANGES))
    every = F.filter("_sample", lambda x, i: (i + 1) % step == 0)
    cuts = drawn.select(*[F.col(c).alias(f"_c_{c}") for c in g], F.array_distinct(every).alias("_cuts"))
    same = F.lit(True)
    for c in g:
        same = same & levels[c].eqNullSafe(cuts[f"_c_{c}"])
    cut = levels.join(cuts, same, "left").drop(*[f"_c_{c}" for c in g])
    below = F.size(F.filter("_cuts", lambda x: x <= F.col("_s")))
    return cut.withColumn("_b", F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(below)).drop("_cuts")


def _split_metrics(judged, g, score_col, rel_col, order_col, k, range_levels):
    """AP / RR@k / NDCG@k without ranking any query inside a single task.

    * tie groups ("levels": one row per query and distinct score) come from a
      partial + final aggregation;
    * AP needs, per level, the candidates and relevant candidates scoring at least as
      high. The levels of a hot query are cut into score ranges at sampled quantiles (see
      :func:`_ranges`), so that they spread over many (query, range) keys. The cumulative
      counts are a window per (query, range) plus the totals of the higher ranges;
    * RR@k and DCG@k need only the top ``k`` candidates (a partial ``WindowGroupLimit``
      before the shuffle) joined to their tie group's mean gain.
    """
    base = judged.select(
        *g, F.col(score_col).alias("_s"), F.col(rel_col).cast("long").alias("_rel"), F.col(order_col).alias("_o")
    )
    levels = base.groupBy(*g, "_s").agg(F.count(F.lit(1)).alias("_n"), F.sum("_rel").alias("_r"))
    lv = _ranges(levels, g, range_levels)
    w_local = Window.partitionBy(*g, "_b").orderBy(F.col("_s").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = lv.select(
        *g, "_b", "_n", "_r",
        F.sum("_n").over(w_local).alias("_cn"), F.sum("_r").over(w_local).alias("_cr"),
    )
    totals = lv.groupBy(*g, "_b").agg(F.sum("_n").alias("_pn"), F.sum("_r").alias("_pr"))
    w_off = Window.partitionBy(*g).orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *g, "_b",
        F.coalesce(F.sum("_pn").over(w_off), F.lit(0)).alias("_on"),
        F.coalesce(F.sum("_pr").over(w_off), F.lit(0)).alias("_or"),
    )
    cum = local.join(offsets, [*g, "_b"], "inner")
    cn = F.col("_cn") + F.col("_on")
    cr = F.col("_cr") + F.col("_or")
    ap_part = cum.groupBy(*g).agg(
        F.sum(F.when(F.col("_r") > 0, F.col("_r") * cr.cast("double") / cn).otherwise(F.lit(0.0))).alias("_apn"),
        F.sum("_r").cast("long").alias("n_rel"),
        F.sum("_n").cast("long").alias("n_cand"),
    )
    w_rank = Window.partitionBy(*g).orderBy(F.col("_s").desc(), F.col("_o").asc())
    top = base.withColumn("_rn", F.row_number().over(w_rank)).filter(F.col("_rn") <= k)
    top = top.join(levels, [*g, "_s"], "inner")
    rr_dcg = top.groupBy(*g).agg(
        F.coalesce(F.max(F.when(F.col("_rel") == 1, F.lit(1.0) / F.col("_rn"))), F.lit(0.0)).alias("rr"),
        F.sum((F.col("_r") / F.col("_n")) / _log2(F.col("_rn") + 1)).alias("_dcg"),
    )
    both = ap_part.join(rr_dcg, g, "inner")
    ap = F.col("_apn") / F.nullif(F.col("n_rel").cast("double"), F.lit(0.0))
    return both.select(
        *g, "n_cand", "n_rel", ap.alias("ap"), "rr", (F.col("_dcg") / _ideal_dcg("n_rel", k)).alias("ndcg")
    )


def _finish(out: DataFrame, g, empty_side: str) -> DataFrame:
    if empty_side == "drop":
        return out.filter((F.col("n_rel") > 0) & (F.col("n_rel") < F.col("n_cand")))
    return out.select(
        *g, "n_cand", "n_rel",
        F.coalesce("ap", F.lit(0.0)).alias("ap"),
        F.col("rr"),
        F.coalesce("ndcg", F.lit(0.0)).alias("ndcg"),
    )


def models_long(judged: DataFrame, id_cols: Sequence[str], model_cols: Sequence[str]) -> DataFrame:
    """Unpivot one score column per model into ``(*id_cols, model, score)``."""
    return judged.unpivot(list(id_cols), list(model_cols), "model", "score")


def rerank_metrics(
    judged_long: DataFrame,
    query_col: str = "qid",
    by: Sequence[str] = ("domain", "model"),
    k: int = 10,
    empty_side: str = "drop",
    **kw,
) -> DataFrame:
    """Mean AP / RR@k / NDCG@k per ``by`` group: ``*by, n_queries, map, mrr@k, ndcg@k``.
    One grouped job for every (domain, model) instead of one pass per evaluation."""
    pq = per_query_metrics(judged_long, [*by, query_col], k=k, empty_side=empty_side, **kw)
    return pq.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.avg("ap").alias("map"),
        F.avg("rr").alias(f"mrr@{k}"),
        F.avg("ndcg").alias(f"ndcg@{k}"),
    )


def rerank_report(
    judged: DataFrame,
    models: Sequence[str],
    query_col: str = "qid",
    domain_col: str = "domain",
    rel_col: str = "rel",
    order_col: str = "seq",
    k: int = 10,
    empty_side: str = "drop",
    metrics: Sequence[str] | None = None,
    method: str = "window",
) -> DataFrame:
    """Long report ``domain, model, metric, value`` for the requested metric subset (default:
    all, named after ``k``). A name that isn't one of them is an error."""
    long = models_long(judged, [query_col, domain_col, rel_col, order_col], models)
    wide = rerank_metrics(
        long, query_col, by=(domain_col, "model"), k=k, empty_side=empty_side, rel_col=rel_col, order_col=order_col,
        method=method,
    )
    all_metrics = ("map", f"mrr@{k}", f"ndcg@{k}")
    rep = wide.unpivot([domain_col, "model"], list(all_metrics), "metric", "value")
    unknown = set(metrics or ()) - set(all_metrics)
    if unknown:
        raise ValueError(f"unknown metrics {sorted(unknown)}: there are {all_metrics}")
    return rep.filter(F.col("metric").isin(list(metrics or all_metrics))).withColumnRenamed(domain_col, "domain")


def score_candidates(judged: DataFrame, scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach a scorer's output (one row per candidate key) back to the judged candidates."""
    return judged.join(scores, list(keys), "inner")
