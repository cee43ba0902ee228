"""Hard-negative and random-negative triplet mining inside each query.

For every query the candidates are ranked by teacher score (descending, ties by input
order ``order_col``). The ``top_k`` best are positives; each positive at rank ``r`` is
paired with the candidates at ranks ``r+1 .. r+num_negatives`` (hard strategy) or a
reproducible pseudo-random choice of ``num_negatives`` candidates ranked below it
(random strategy). Pairs with equal passage, or without a strictly positive score
margin, are dropped afterwards -- dropped slots are not back-filled.

Plan shape (hard): the rank filter ``rank <= top_k + num_negatives`` is planned as a
partial ``WindowGroupLimit`` *before* the shuffle, so even a query holding a large share
of all rows ships at most ``top_k + num_negatives`` rows per map task; the ranking window
and the "next n rows" frame share one exchange and one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from distillery.functions.numeric import fix9
from distillery.operators.skew import hot_keys, part_of, with_parts


def _check(top_k: int, num_negatives: int) -> None:
    if top_k <= 0 or num_negatives <= 0:
        raise ValueError("top_k and num_negatives must be positive")


def quarantine_scores(scored: DataFrame, score_col: str) -> tuple[DataFrame, DataFrame]:
    """Split into (rankable, quarantined): NULL or NaN scores cannot be ranked."""
    bad = F.col(score_col).isNull() | F.isnan(F.col(score_col))
    return scored.filter(~bad), scored.filter(bad)


def rank_window(group_cols: Sequence[str], score_col: str, order_col: str):
    return Window.partitionBy(*group_cols).orderBy(F.col(score_col).desc(), F.col(order_col).asc())


def mine_hard_negatives(
    scored: DataFrame,
    group_cols: Sequence[str],
    passage_col: str,
    score_col: str = "score",
    order_col: str = "seq",
    top_k: int = 8,
    num_negatives: int = 4,
    carry_cols: Sequence[str] = (),
    first_seen: bool = False,
) -> DataFrame:
    """Margin triplets ``*group_cols, positive, negative, pos_rank, neg_rank, score``
    (``score`` = teacher margin, fixed to 9 decimals) plus ``<carry>_pos/_neg``.

    ``first_seen=True`` adds ``first_seen`` (the smallest ``order_col`` of the query) so
    the output can be sorted in first-seen query order, then positive rank, negative rank.
    """
    _check(top_k, num_negatives)
    rankable, _ = quarantine_scores(scored, score_col)
    w = rank_window(group_cols, score_col, order_col)
    cols = [passage_col, score_col, *carry_cols]
    ranked = rankable.withColumn("_rank", F.row_number().over(w)).filter(
        F.col("_rank") <= top_k + num_negatives
    )
    nxt = ranked.withColumn(
        "_next",
        F.collect_list(F.struct(F.col("_rank").alias("rank"), *[F.col(c) for c in cols])).over(
            w.rowsBetween(1, num_negatives)
        ),
    )
    keep = list(group_cols)
    pos = nxt.filter(F.col("_rank") <= top_k).select(
        *keep,
        F.col("_rank").cast("long").alias("pos_rank"),
        *[F.col(c).alias(f"{c}_pos") for c in cols],
        F.explode("_next").alias("n"),
    )
    margin = F.col(f"{score_col}_pos") - F.col(f"n.{score_col}")
    out = pos.select(
        *keep,
        F.col(f"{passage_col}_pos").alias("positive"),
        F.col(f"n.{passage_col}").alias("negative"),
        "pos_rank",
        F.col("n.rank").cast("long").alias("neg_rank"),
        fix9(margin).alias("score"),
        *[F.col(f"{c}_pos") for c in carry_cols],
        *[F.col(f"n.{c}").alias(f"{c}_neg") for c in carry_cols],
        margin.alias("_margin"),
    )
    out = out.filter(
        (F.col("positive") != F.col("negative")) & (F.col("_margin") > 0) & ~F.isnan(F.col("_margin"))
    ).drop("_margin")
    if first_seen:
        # partial aggregation (skew-safe), joined to the output, which is at most
        # top_k * num_negatives rows per query
        seen = rankable.groupBy(*group_cols).agg(F.min(order_col).alias("first_seen"))
        out = out.join(seen, list(group_cols), "inner")
    return out


def mine_random_negatives(
    scored: DataFrame,
    group_cols: Sequence[str],
    passage_col: str,
    score_col: str = "score",
    order_col: str = "seq",
    top_k: int = 8,
    num_negatives: int = 4,
    seed: int = 0,
    carry_cols: Sequence[str] = (),
    key_col: str | None = None,
    rows_per_salt: int = 20_000,
) -> DataFrame:
    """Random strategy: each positive (rank ``r <= top_k``) draws ``min(pool, n)``
    candidates from the pool ranked below it. The draw orders the pool by
    ``md5(seed|group|r|key of the candidate)``: reproducible, and computable in any engine.
    ``key_col`` (default: ``order_col``) must not depend on how the input is split: a line
    number, an id, a digest. Candidates of equal key are taken in ``order_col`` order.

    Output ``*group_cols, positive, negative, pos_rank, neg_seq, score`` (+ carries).

    No whole-query window: the positives are a top-k (partial ``WindowGroupLimit``). A query
    with more than ``rows_per_salt`` candidates is salted: its candidates are dealt over as
    many salts as it takes, its positives are copied to each, every (positive, salt) draws
    its best ``num_negatives``, and a last top-n over at most ``salts * num_negatives`` rows
    merges them. The draw key doesn't know the salts, so the result is the same for any number.
    ``scored`` is read three times: store it if it is dear. The group key must be one column.
    """
    _check(top_k, num_negatives)
    if len(group_cols) != 1:
        raise ValueError("random strategy needs exactly one group column")
    g = group_cols[0]
    key_col = key_col or order_col
    rankable, _ = quarantine_scores(scored, score_col)
    w = rank_window(group_cols, score_col, order_col)
    hot = hot_keys(rankable, group_cols, rows_per_salt)
    cols = list(dict.fromkeys([passage_col, score_col, order_col, *carry_cols]))
    positives = (
        rankable.withColumn("pos_rank", F.row_number().over(w).cast("long"))
        .filter(F.col("pos_rank") <= top_k)
        .select(*group_cols, "pos_rank", *[F.col(c).alias(f"{c}_pos") for c in cols])
    )
    positives = with_parts(positives, hot, group_cols).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    cands = rankable.select(*group_cols, F.col(key_col).alias("_key"), *[F.col(c).alias(f"{c}_neg") for c in cols])
    cands = with_parts(cands, hot, group_cols).withColumn(
        "_salt", part_of(F.col("_parts"), F.col("_key"), F.col(f"{order_col}_neg"))).drop("_parts")
    s_pos, s_neg = F.col(f"{score_col}_pos"), F.col(f"{score_col}_neg")
    below = (s_neg < s_pos) | ((s_neg == s_pos) & (F.col(f"{order_col}_neg") > F.col(f"{order_col}_pos")))
    pool = positives.join(cands, [g, "_salt"], "inner").filter(below)
    draw_key = F.md5(
        F.concat_ws(
            "|", F.lit(str(seed)), F.col(g).cast("string"), F.col("pos_rank").cast("string"), F.col("_key").cast("string"),
        )
    )
    pool = pool.withColumn("_draw_key", draw_key)
    best = [F.col("_draw_key"), F.col(f"{order_col}_neg")]
    # the join has dealt by (group, salt): the first top-n needs no further exchange
    local = Window.partitionBy(g, "_salt", "pos_rank").orderBy(*best)
    some = pool.withColumn("_draw", F.row_number().over(local)).filter(F.col("_draw") <= num_negatives)
    merged = Window.partitionBy(g, "pos_rank").orderBy(*best)
    drawn = some.withColumn("_draw", F.row_number().over(merged)).filter(F.col("_draw") <= num_negatives)
    margin = s_pos - s_neg
    out = drawn.select(
        *group_cols,
        F.col(f"{passage_col}_pos").alias("positive"),
        F.col(f"{passage_col}_neg").alias("negative"),
        "pos_rank",
        F.col(f"{order_col}_neg").alias("neg_seq"),
        fix9(margin).alias("score"),
        *[F.col(f"{c}_pos") for c in carry_cols],
        *[F.col(f"{c}_neg") for c in carry_cols],
        margin.alias("_margin"),
    )
    return out.filter(
        (F.col("positive") != F.col("negative")) & (F.col("_margin") > 0) & ~F.isnan(F.col("_margin"))
    ).drop("_margin")
