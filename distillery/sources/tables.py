"""Driver parquet tables. Reads name only the needed columns so the scan's
``ReadSchema`` is pruned (parquet is columnar: an unused ``text`` column costs nothing)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from distillery.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """Round-robin an input that arrives in fewer partitions than the cluster's default
    parallelism (a small file is one split) before CPU-heavy per-row work, so that work
    is not serialized into one task. Large inputs already have at least that many splits
    and pass through unchanged (a plan-time metadata check, no data read)."""
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
