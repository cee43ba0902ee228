"""Incremental processing of sample / scored-pair JSONL files as they arrive.

* Per-sample stages (flattening to pairs, prompt text, teacher log-odds from a
  log-probability column) are stateless: a plain ``readStream`` -> ``writeStream``.
* Mining needs every candidate of a query. Each input file is self-contained (queries
  never span files), so the file source with ``foreachBatch`` mines each micro-batch as
  a batch job grouped by ``source_file`` -- no streaming state is needed.

The checkpoint location must be a shared, durable folder (it is what lets a restarted
query resume without reprocessing or losing files).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from distillery import schemas
from distillery.operators import pairs
from distillery.plans.reranker import margin_triplets
from distillery.sources.jsonl import write_jsonl


def stream_samples(spark: SparkSession, input_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    return (
        spark.readStream.schema(schemas.SAMPLE).option("maxFilesPerTrigger", max_files_per_trigger)
        .json(input_dir)
        .select("*", F.col("_metadata.file_path").alias("source_file"))
    )


def stream_pairs(spark: SparkSession, input_dir: str) -> DataFrame:
    """Streaming (query, passage) pairs of arriving sample files (stateless)."""
    s = stream_samples(spark, input_dir).withColumn("sample_md5", F.md5(F.to_json(F.struct("query", "positive",
                                                                                          "negative"))))
    return pairs.samples_to_pairs(s, ["source_file", "sample_md5"])


def start_pair_stream(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_dir: str,
                      trigger_once: bool = True) -> StreamingQuery:
    q = stream_pairs(spark, input_dir).writeStream.format("json").option("path", output_dir).option(
        "checkpointLocation", checkpoint_dir).outputMode("append")
    q = q.trigger(availableNow=True) if trigger_once else q
    return q.start()


def start_triplet_stream(
    spark: SparkSession, scored_dir: str, output_dir: str, checkpoint_dir: str, top_k: int = 8,
    num_negatives: int = 4, trigger_once: bool = True,
) -> StreamingQuery:
    """Mine margin triplets from scored-pair files as they arrive (one batch job per
    micro-batch of whole files). Writes ``output_dir/batch=<id>``; idempotent per batch id."""
    stream = (
        spark.readStream.schema(schemas.SCORED_PAIR).option("maxFilesPerTrigger", 1).json(scored_dir)
        .select("*", F.col("_metadata.file_path").alias("source_file"),
                F.col("_metadata.file_block_start").alias("_block"))
        # the readers' rule: what lacks a key or a rankable score takes no part
        .filter(F.col("query").isNotNull() & F.col("passage").isNotNull() & F.col("score").isNotNull() & ~F.isnan("score"))
    )

    def mine(batch: DataFrame, batch_id: int) -> None:
        # the micro-batch is a static plan straight over the new files' splits, so row
        # ids taken here still follow line order inside each split
        ordered = batch.withColumn(
            "seq", F.struct(F.col("_block").alias("block"), F.monotonically_increasing_id().alias("row"))
        ).drop("_block")
        t = margin_triplets(ordered, top_k, num_negatives).select(
            "source_file", "query", "positive", "negative", "score")
        write_jsonl(t, f"{output_dir}/batch={batch_id}")

    w = stream.writeStream.foreachBatch(mine).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
