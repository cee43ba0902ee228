"""Cutting hot keys by their counts: which keys have more rows than a task should take, and
into how many parts. Keys below the bound are left out, so the table stays small (at most
one row for each ``rows_per_part`` input rows)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_part: int, out: str = "_parts", where: Column | None = None) -> DataFrame:
    """``*keys, out``: the number of parts (2 or more) of each key with more than
    ``rows_per_part`` rows. One aggregation, counted before the shuffle."""
    if rows_per_part <= 0:
        raise ValueError("rows_per_part must be positive")
    one = F.lit(1) if where is None else F.when(where, F.lit(1))
    counts = df.groupBy(*keys).agg(F.count(one).alias("_n")).filter(F.col("_n") > rows_per_part)
    return counts.select(*keys, F.ceil(F.col("_n") / rows_per_part).cast("int").alias(out))


def with_parts(df: DataFrame, hot: DataFrame, keys: Sequence[str], out: str = "_parts") -> DataFrame:
    """``df`` with the number of parts of its key: 1 unless the key is hot. NULL keys match."""
    h = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.col(out).alias("_hot_parts"))
    same = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(h[f"_hot_{k}"])
    return df.join(h, same, "left").withColumn(out, F.coalesce("_hot_parts", F.lit(1))).drop(
        "_hot_parts", *[f"_hot_{k}" for k in keys])


def part_of(parts: Column, *by: Column) -> Column:
    """The part (from 0) that a row falls into, by a hash of its own columns."""
    return F.pmod(F.xxhash64(*by), parts.cast("long")).cast("int")
