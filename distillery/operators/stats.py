"""Dataset statistics, per-source output counts and a preview row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dataset_stats(samples: DataFrame, query_col="query", positive_col="positive", negative_col="negative",
                  approx: bool = False) -> DataFrame:
    """One row: samples, distinct queries (exact, or ``approx_count_distinct`` for very
    large inputs), candidate pairs, positives, negatives. As in the pairs themselves, NULL
    elements of a list are no candidates, and a NULL list has none."""
    count = lambda c: F.coalesce(F.size(F.filter(c, lambda x: x.isNotNull())), F.lit(0))
    npos, nneg = (F.when(F.col(c).isNull(), F.lit(0)).otherwise(count(c)) for c in (positive_col, negative_col))
    distinct = F.approx_count_distinct(query_col) if approx else F.count_distinct(F.col(query_col))
    return samples.agg(
        F.count(F.lit(1)).alias("n_samples"),
        distinct.cast("long").alias("n_queries"),
        F.sum(npos + nneg).cast("long").alias("n_pairs"),
        F.sum(npos).cast("long").alias("n_positive"),
        F.sum(nneg).cast("long").alias("n_negative"),
    )


def triplet_counts(triplets: DataFrame, source_cols: Sequence[str] = ("source_file",)) -> DataFrame:
    """Rows per source and the grand total (the total row has NULL source)."""
    return triplets.rollup(*source_cols).agg(F.count(F.lit(1)).alias("n_triplets"))


def preview(df: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """The first row in input order (a top-1, not a global sort)."""
    return df.orderBy(*order_cols).limit(1)
