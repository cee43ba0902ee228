"""Connected components of a distributed graph by alternating large-star and small-star steps
(each node links its larger neighbours, then its smaller ones, to the smallest node it
sees). Every step is an aggregation and a join; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distillery.llm.common import stored


def _smallest(arcs: DataFrame) -> DataFrame:
    """``arcs`` (u, v) with m, the least of u and its v. The minimum is pre-aggregated before
    its shuffle and stored, so that the join back can be split at a node with very many arcs."""
    least = stored(arcs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")))
    return arcs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """``v, root`` for every node of ``edges`` (u, v: longs) that isn't its component's smallest
    node, which is ``root``. Loops and repeated edges do no harm."""
    edges = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        both = stored(edges.union(edges.select("v", "u")))
        large = _smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u <> v").distinct())
        small = _smallest(large)
        edges = stored(small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("v"), F.col("v").alias("root"))
        state = now
