"""JSON-lines readers and sinks with the three read modes of the pipelines.

* ``strict``  -- a malformed line or a missing ``query`` fails the job (FAILFAST);
  a missing list is an empty list.
* ``lenient`` -- malformed lines / missing fields are quarantined, not fatal
  (PERMISSIVE + ``_corrupt_record``); readers return ``(good, quarantined)``.
* ``truthy``  -- like strict, then samples whose query or either list is missing or
  empty are dropped.

Every reader adds ``source_file`` (files are processed independently: it is part of every
grouping key downstream) and ``seq``, the input-order tie-breaker, attached directly above
the scan: ``(file_block_start, monotonically_increasing_id())`` -- split offset first, so
line order survives a file being read as several splits.
``.gz`` input is read directly; it is unsplittable, so a large one is repartitioned.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from distillery import schemas
from distillery.functions.text import all_truthy, suffixed_path

MODES = ("strict", "lenient", "truthy")


def existing_paths(spark: SparkSession, paths: Sequence[str] | str, on_missing: str = "skip") -> list[str]:
    """Driver-side metadata check (no data read): drop (``skip``) or reject (``error``)
    input paths that do not exist. Globs count as existing when they match."""
    if isinstance(paths, str):
        paths = [paths]
    if on_missing not in ("skip", "error"):
        raise ValueError("on_missing must be 'skip' or 'error'")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    keep = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        matches = fs.globStatus(hp)
        if matches is not None and len(matches) > 0:
            keep.append(p)
        elif on_missing == "error":
            raise FileNotFoundError(p)
    return keep


def with_input_order(df: DataFrame) -> DataFrame:
    """Adds ``source_file`` and ``seq`` (struct of split offset and row id). Must sit
    directly on the scan: after a shuffle, row ids no longer follow file order."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("seq"),
    )


def _empty(spark: SparkSession, schema) -> DataFrame:
    df = spark.createDataFrame([], schema)
    return df.select("*", F.lit(None).cast("string").alias("source_file"),
                     F.lit(None).cast("struct<block:bigint,row:bigint>").alias("seq"))


def _read(spark, paths, schema, mode: str, on_missing: str, min_partitions: int | None):
    found = existing_paths(spark, paths, on_missing)
    lenient = mode == "lenient"
    if not found:
        return _empty(spark, schemas.with_corrupt(schema) if lenient else schema)
    reader = spark.read.schema(schemas.with_corrupt(schema) if lenient else schema)
    if lenient:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", schemas.CORRUPT_COL)
    else:
        reader = reader.option("mode", "FAILFAST")
    df = with_input_order(reader.json(found))
    if min_partitions and df.rdd.getNumPartitions() < min_partitions:
        # gzip input arrives as one partition per file; spread it before heavy work
        df = df.repartition(min_partitions)
    return df


def read_lines(spark: SparkSession, paths, schema, min_partitions: int | None = None) -> DataFrame:
    """Every line of JSONL files, malformed ones too: the fields (NULL where malformed), the
    corrupt record, ``source_file`` and ``seq``."""
    return _read(spark, paths, schema, "lenient", "skip", min_partitions)


def _touch(array_cols) -> F.Column:
    """An always-false predicate that references every list field. JSON parsing is pruned
    to the referenced fields, and a type error in an unreferenced field does not mark the
    record corrupt -- so without this, the good/quarantined split would depend on which
    columns a consumer selects. ``size`` of a parsed array is never below -1."""
    cond = F.lit(False)
    for c in array_cols:
        cond = cond | (F.size(F.col(c)) < -1)
    return cond


def read_samples(
    spark: SparkSession, paths, mode: str = "strict", on_missing: str = "skip", min_partitions: int | None = None,
):
    """Reranking samples ``query, positive[], negative[], source_file, seq``.

    strict/truthy return a DataFrame; lenient returns ``(good, quarantined)``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    df = _read(spark, paths, schemas.SAMPLE, mode, on_missing, min_partitions)
    empty = F.array().cast("array<string>")
    lists = [F.coalesce(F.col("positive"), empty).alias("positive"),
             F.coalesce(F.col("negative"), empty).alias("negative")]
    if mode == "strict":
        # referencing the lists keeps them parsed, so FAILFAST sees a wrong-typed list even
        # when a consumer selects only the query
        missing = F.col("query").isNull() | _touch(["positive", "negative"])
        query = F.when(missing, F.raise_error(F.lit("sample without 'query'"))).otherwise(F.col("query"))
        return df.select(query.alias("query"), *lists, "source_file", "seq")
    if mode == "truthy":
        return df.filter(all_truthy(strings=["query"], arrays=["positive", "negative"])).select(
            "query", "positive", "negative", "source_file", "seq")
    bad = F.col(schemas.CORRUPT_COL).isNotNull() | F.col("query").isNull() | _touch(["positive", "negative"])
    good = df.filter(~bad).select("query", *lists, "source_file", "seq")
    return good, df.filter(bad)


def read_scored_pairs(
    spark: SparkSession, paths, on_missing: str = "skip", min_partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Teacher-scored pairs, lenient: ``(good, quarantined)``. Quarantined: malformed
    JSON, a missing key, a non-numeric score (NULL + corrupt record), NaN or NULL score."""
    df = _read(spark, paths, schemas.SCORED_PAIR, "lenient", on_missing, min_partitions)
    bad = (
        F.col(schemas.CORRUPT_COL).isNotNull()
        | F.col("query").isNull() | F.col("passage").isNull() | F.col("score").isNull() | F.isnan("score")
    )
    good = df.filter(~bad).select("query", "passage", "score", "source_file", "seq")
    return good, df.filter(bad)


def read_triplets(spark: SparkSession, path, kind: str = "margin") -> DataFrame:
    """Training triplets with their fixed contract; the training score is float32."""
    if kind == "margin":
        df = spark.read.schema(schemas.MARGIN_TRIPLET).option("mode", "FAILFAST").json(path)
        return df.withColumn("score", F.col("score").cast(schemas.TRAINING_SCORE_TYPE))
    if kind == "soft":
        df = spark.read.schema(schemas.SOFT_TRIPLET).option("mode", "FAILFAST").json(path)
        return df.withColumn("label", F.col("label").cast("array<float>"))
    raise ValueError("kind must be 'margin' or 'soft'")


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """UTF-8 JSON lines, non-ASCII unescaped, NULL fields written as ``null``. The result
    is a directory of part files. Never write NaN (Spark would emit the string "NaN")."""
    w = df.write.mode(mode).option("ignoreNullFields", "false")
    if partition_by:  # a run replaces the outputs it writes and leaves the others alone
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.json(path)


def output_name(source_col: str = "source_file", suffix: str = "") -> F.Column:
    """Per-input output name: ``<base><suffix><ext>`` of the input file name. A part file
    of an earlier stage's output (``.../output=<name>/part-*``) counts as ``<name>``, so
    chained stages keep the original input's name."""
    path = F.col(source_col)
    stage = F.regexp_extract(path, r"/output=([^/]+)/[^/]*$", 1)
    base = F.when(stage != "", stage).otherwise(F.element_at(F.split(path, "/"), -1))
    return suffixed_path(base, suffix)


def run_per_source(
    df: DataFrame, fn: Callable[[DataFrame], DataFrame], path: str, suffix: str, source_col: str = "source_file"
) -> None:
    """One job for all inputs: ``fn`` must keep ``source_col`` in its grouping keys; the
    output is partitioned by the suffixed input name (one directory per input file)."""
    out = fn(df).withColumn("output", output_name(source_col, suffix)).drop(source_col)
    write_jsonl(out, path, partition_by=["output"])


def written_outputs(spark: SparkSession, path: str) -> DataFrame:
    """The ``output`` column of what :func:`run_per_source` wrote: nothing is inferred from the
    data, so a folder without any record is an empty table."""
    return spark.read.schema("output string").json(path)


def write_training_shards(df: DataFrame, path: str, rows_per_shard: int = 512, mode: str = "overwrite",
                          order: Sequence[str] = ()) -> None:
    """Training export: files of exactly ``rows_per_shard`` rows (one optimizer step of
    16 x 32 = 512 triplets by default), but for the last one. Files read by name hold the rows
    by ``order`` (which should be unique), or in the order of ``df``'s partitions."""
    from distillery.sources.ordering import in_shards

    in_shards(df, rows_per_shard, order).write.mode(mode).option("maxRecordsPerFile", rows_per_shard).option(
        "ignoreNullFields", "false").json(path)
