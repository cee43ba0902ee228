"""Row numbers and ordered part files.

A distributed result has no order of its own; these helpers give it one that survives being
written as many files. Row numbers come from counts of each partition and a prefix sum over
them; ordered outputs are range-partitioned, so that part files read by name are in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from distillery.session import cut_lineage

_ROW_BITS = (1 << 33) - 1  # of monotonically_increasing_id: the row within its partition


def with_line_numbers(df: DataFrame, file_col: str = "source_file", seq_col: str = "seq", out: str = "line",
                      group: Sequence[str] = (), filtered: bool = False) -> DataFrame:
    """``df`` with ``out``: the row's number (from 0) in its file, or in its ``group`` of files
    taken in the order of their names, however the files were split for reading.

    ``seq`` is the pair (split offset, row id) of :func:`jsonl.with_input_order`. The rows of
    each split are counted, the counts added up over the file's splits in order of offset, and
    the row's place within its split added. The table of splits is small: a row for each.
    Where rows of the files are missing (``filtered``), those left are numbered, by a sort within
    each split."""
    if filtered:
        inside = Window.partitionBy(*dict.fromkeys([*(group or [file_col]), file_col]), f"{seq_col}.block").orderBy(f"{seq_col}.row")
        dense = F.struct(F.col(f"{seq_col}.block").alias("block"), (F.row_number().over(inside) - 1).cast("long").alias("row"))
        numbered = with_line_numbers(df.withColumn("_dense", dense), file_col, "_dense", out, group)
        return numbered.select(*df.columns, out)
    block, row = F.col(f"{seq_col}.block"), F.col(f"{seq_col}.row")
    keys = list(group) or [file_col]
    splits = df.groupBy(*dict.fromkeys([*keys, file_col]), block.alias("_block")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(row).alias("_first"))
    before = Window.partitionBy(*keys).orderBy(file_col, "_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    names = list(dict.fromkeys([*keys, file_col]))
    table = splits.select(*[F.col(c).alias(f"_s_{c}") for c in names], F.col("_block").alias("_s_block"), "_first", "_before", "_n")
    same = block == F.col("_s_block")
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    place = row - F.col("_first")
    # both reads of the files are planned alike; should they ever not be, no number is made up
    sound = F.col("_first").isNotNull() & (place >= 0) & (place < F.col("_n"))
    number = F.when(sound, F.col("_before") + place).otherwise(
        F.raise_error(F.lit("the input was split differently while it was being numbered")).cast("long"))
    return df.join(table, same, "left").withColumn(out, number).select(*df.columns, out)


def with_row_numbers(df: DataFrame, order: Sequence[Column | str] = (), out: str = "row_number") -> DataFrame:
    """A stored copy of ``df`` with ``out``: the number (from 0) of each row, by ``order`` if given
    (which should be unique), else by the layout of the copy.

    The copy is a reliable checkpoint, so that a row keeps its place when a task is run again.
    With an ``order``, rows are range-partitioned and sorted first."""
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = cut_lineage(df.select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("_place")))
    counts = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # a row for each partition: a small table
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return stored.join(counts, F.col("_part") == F.col("_p")).withColumn(
        out, F.col("_before") + F.col("_place")).drop("_part", "_place", "_p", "_before")


def in_file_order(df: DataFrame, order: Sequence[str], first: Sequence[str] = ()) -> DataFrame:
    """``df`` dealt by ranges of ``first + order`` and sorted within them: written, its part files
    read by name are in that order. ``first`` are the columns by which the output is split up
    into folders."""
    by = [*first, *order]
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def in_shards(df: DataFrame, rows_per_shard: int, order: Sequence[Column | str] = (), shards_per_task: int = 64) -> DataFrame:
    """The rows of ``df`` in order, dealt so that a writer that begins a new file after every
    ``rows_per_shard`` rows makes files of exactly so many rows, but for the last one.

    Rows are numbered; each task gets a whole number of runs of ``shards_per_task`` shards,
    neighbouring runs, in order."""
    if rows_per_shard <= 0 or shards_per_task <= 0:
        raise ValueError("rows_per_shard and shards_per_task must be positive")
    numbered = with_row_numbers(df, order, "_number")
    run = F.floor(F.col("_number") / (rows_per_shard * shards_per_task))
    # so many tasks that a task's files, and all tasks, are numbered by names that sort
    n_runs = (numbered.agg(F.max(run)).first()[0] or 0) + 1
    tasks = min(n_runs, 99_999)
    dealt = numbered.withColumn("_run", run).repartitionByRange(tasks, "_run").sortWithinPartitions("_run", "_number")
    return dealt.drop("_run", "_number")
