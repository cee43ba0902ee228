"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from distillery.session import ensure_checkpoint_dir

#: Characters of text that a Python helper holds decoded at once, besides a single row.
SLICE_CHARS = 1_000_000


def shared_folder(spark) -> str:
    """A fresh folder below the session's ``spark.checkpoint.dir``."""
    top = ensure_checkpoint_dir(spark)
    if top is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{top.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to a Parquet table in the shared folder and read it back: the lineage is
    cut, a lost executor loses nothing, and joins see an exchange on both sides, which
    adaptive execution can split when a key is hot."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROW_BITS = (1 << 33) - 1  # of monotonically_increasing_id: the row within its partition


def parts_of(df: DataFrame) -> int:
    """The number of partitions that ``df`` is planned with."""
    return max(1, df.rdd.getNumPartitions())


def stored_by_part(df: DataFrame, parts: int) -> DataFrame:
    """Like :func:`stored`, with each row's place: ``x_part`` (the partition that wrote it) and
    ``x_at`` (its number there, from 0). The table is bucketed by ``x_part``, one file a partition,
    so that a join on ``x_part`` reads these rows where they are: what was decided about them
    comes to them (see :func:`decided`), however long their texts."""
    spark = df.sparkSession
    path, name = shared_folder(spark), f"llm_{uuid.uuid4().hex}"
    placed = df.select("*", F.spark_partition_id().alias("x_part"),
                       F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS)).alias("x_at"))
    placed.write.format("parquet").bucketBy(parts, "x_part").option("path", path).saveAsTable(name)
    out = spark.table(name).select(*placed.columns)
    out.schema  # noqa: B018  resolved, then the name isn't needed any more
    return out


def decided(rows: DataFrame, decisions: DataFrame, out: str, parts: int) -> DataFrame:
    """``rows`` of :func:`stored_by_part` with ``out``: a struct of the other columns of
    ``decisions``, which have one row for each of ``rows``, by ``x_part, x_at``. The decisions
    are gathered by partition, as many of them as it has rows, and looked up by place. They are
    dealt into the table's ``parts`` buckets: else the side of more partitions would be kept."""
    fields = [c for c in decisions.columns if c not in ("x_part", "x_at")]
    lists = decisions.groupBy(F.col("x_part").alias("x_p")).agg(
        F.sort_array(F.collect_list(F.struct("x_at", *fields))).alias("x_list"))
    told = rows.join(lists.repartition(parts, "x_p"), F.col("x_part") == F.col("x_p"))
    return told.withColumn(out, F.get("x_list", F.col("x_at").cast("int"))).drop("x_p", "x_list")


def text_key(text: Column) -> Column:
    """128-bit digest of a text (null and empty differ), as two longs."""
    return F.struct(F.xxhash64(text, F.lit(1)).alias("a"), F.xxhash64(F.lit(2), text, text.isNull()).alias("b"))


def in_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
              chars: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Each Arrow batch cut into slices of a bounded amount of text, with its decoded texts
    (None where null). A single longer row is a slice of its own."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(at)), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > chars:
                part = batch.slice(start, i - start)
                yield part, part.column(at).to_pylist()
                start, total = i, 0
            total += size
        if start < len(sizes):
            part = batch.slice(start)
            yield part, part.column(at).to_pylist()


def map_texts(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow``: no shuffle, one pass over the scan's partitions. A task drops what earlier
    tasks have left in its Python worker, and hands its own freed memory back, as the worker
    lives on beside those of other stages."""
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()
        try:
            yield from function(batches)
        finally:
            hand_back()

    return df.mapInArrow(mapped, schema)


def hand_back() -> None:
    """Return freed memory to the system: Arrow's and, where the C library can, its own. A
    task's functions come with their own copy of the package, which only the collector of
    cycles lets go of."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def prefix_sum(df: DataFrame, value: Column, key: list[str], out: str, group: tuple[str, ...] = (),
               bucket: Callable[[int], Column] | None = None, total: int | None = None,
               rows_per_bucket: int = 2_000) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the rows before, in a fixed order of each
    group: by bucket, then by ``key`` (unique). Buckets are drawn by a hash of the key, or by
    ``bucket`` (of their number); sums by bucket are added up over the small table of buckets,
    and each bucket is summed on its own, so that a hot group is spread over all its buckets.
    ``df`` is read twice and should be stored."""
    n = max(1, (df.count() if total is None else total) // rows_per_bucket)
    by = bucket(n) if bucket else F.pmod(F.xxhash64(F.lit("prefix"), *key), F.lit(n))
    spread = df.withColumn("x_value", value.cast("long")).withColumn("x_bucket", by.cast("long"))
    sums = spread.groupBy(*group, "x_bucket").agg(F.sum("x_value").alias("x_sum"))
    before = Window.partitionBy(*group).orderBy("x_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(c).alias(f"x_{c}") for c in group], F.col("x_bucket").alias("x_b"),
                       F.coalesce(F.sum("x_sum").over(before), F.lit(0)).alias("x_before"))
    same = F.col("x_bucket") == F.col("x_b")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"x_{c}"))
    inside = Window.partitionBy(*group, "x_bucket").orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    return spread.join(sums, same).withColumn(
        out, F.col("x_before") + F.coalesce(F.sum("x_value").over(inside), F.lit(0))).select(*df.columns, out)
