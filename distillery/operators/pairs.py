"""Sample -> pair -> triplet reshaping (long form is the working representation).

A reranking sample arrives nested (``query, positive[], negative[]``); everything
downstream works on one row per (sample, candidate) so no operator ever needs a whole
candidate list in one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distillery.operators.skew import hot_keys, part_of, with_parts

POSITIVE = "positive"
NEGATIVE = "negative"


def _side_entries(col: str, side: str, rel: int, array_type: str = "array<string>"):
    return F.transform(
        F.coalesce(F.col(col), F.array().cast(array_type)),
        lambda x, i: F.struct(
            F.lit(side).alias("side"), i.alias("pos"), F.lit(rel).alias("rel"), x.alias("passage")
        ),
    )


def samples_to_pairs(
    samples: DataFrame,
    key_cols: Sequence[str],
    query_col: str = "query",
    positive_col: str = "positive",
    negative_col: str = "negative",
) -> DataFrame:
    """Flatten samples to (query, passage) pairs: all positives, then all negatives, in
    list order. Output ``*key_cols, query, side, pos, rel, passage``. Passages may be
    texts or ids (any array element type).

    A missing list counts as empty; NULL list elements are dropped. One pass: both lists
    are turned into one array of structs and exploded (no union, no second scan).
    """
    types = dict(samples.dtypes)
    entries = F.concat(
        _side_entries(positive_col, POSITIVE, 1, types[positive_col]),
        _side_entries(negative_col, NEGATIVE, 0, types[negative_col]),
    )
    exploded = samples.select(*key_cols, F.col(query_col).alias("query"), F.explode(entries).alias("e"))
    return exploded.select(
        *key_cols, "query", "e.side", "e.pos", "e.rel", "e.passage"
    ).filter(F.col("passage").isNotNull())


#: Candidates of one side that a block of the product holds, on average.
BLOCK_ROWS = 2_000


def cross_sides(
    pairs: DataFrame,
    key_cols: Sequence[str],
    side_col: str = "side",
    id_cols: Sequence[str] = ("pos",),
    carry_cols: Sequence[str] = (),
    block_rows: int | None = BLOCK_ROWS,
) -> DataFrame:
    """Positive x negative product inside each sample (positive-major, duplicates kept,
    no inequality filter). Columns of the positive side get suffix ``_pos``, of the
    negative side ``_neg``.

    An equi-join on the sample key and a block of it. The sides of a sample with more than
    ``block_rows`` positives or negatives are cut, by a hash of ``id_cols``, into a grid of
    blocks: each positive is copied to every block of negatives and each negative to every
    block of positives, so a join key never has more than about ``block_rows`` rows on either
    side, and its product about ``block_rows ** 2`` rows, however large the sample. (Rows that
    agree in all ``id_cols`` share a block.) Samples below that have the one block (0, 0).
    ``pairs`` is read four times, twice only to count: store it if it is dear. Where samples
    are small by construction, ``block_rows=None`` saves counting them.
    """
    keys = list(key_cols)
    cols = list(id_cols) + [c for c in carry_cols if c not in id_cols]
    if block_rows is None:
        sides = [pairs.filter(F.col(side_col) == name).select(*keys, *[F.col(c).alias(f"{c}{suffix}") for c in cols])
                 for name, suffix in ((POSITIVE, "_pos"), (NEGATIVE, "_neg"))]
        return sides[0].join(sides[1], keys, "inner")
    n_pos = hot_keys(pairs, keys, block_rows, "_np", F.col(side_col) == POSITIVE)
    n_neg = hot_keys(pairs, keys, block_rows, "_nn", F.col(side_col) == NEGATIVE)

    def side(name: str, suffix: str, own: str, other: str, own_block: str, other_block: str) -> DataFrame:
        rows = pairs.filter(F.col(side_col) == name).select(*keys, *[F.col(c).alias(f"{c}{suffix}") for c in cols])
        rows = with_parts(with_parts(rows, n_pos, keys, "_np"), n_neg, keys, "_nn")
        at = part_of(F.col(own), *[F.col(f"{c}{suffix}") for c in id_cols])
        return rows.withColumn(own_block, at).withColumn(
            other_block, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("_np", "_nn")

    pos = side(POSITIVE, "_pos", "_np", "_nn", "_bp", "_bn")
    neg = side(NEGATIVE, "_neg", "_nn", "_np", "_bn", "_bp")
    return pos.join(neg, [*keys, "_bp", "_bn"], "inner").drop("_bp", "_bn")


def distinct_texts(
    samples: DataFrame,
    query_col: str = "query",
    positive_col: str = "positive",
    negative_col: str = "negative",
) -> DataFrame:
    """Distinct union of query, positive and negative texts (embed each text once).
    Partial aggregation removes duplicates map-side before the shuffle."""
    texts = F.concat(
        F.array(F.col(query_col)),
        F.coalesce(F.col(positive_col), F.array().cast("array<string>")),
        F.coalesce(F.col(negative_col), F.array().cast("array<string>")),
    )
    return (
        samples.select(F.explode(texts).alias("text"))
        .filter(F.col("text").isNotNull())
        .groupBy("text")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
