"""Registered queries of the file stages: JSONL written from the driver tables into the shared
folder, read back and run through the same functions as the command line."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from distillery.functions import text as tf
from distillery.functions.numeric import fix6
from distillery.operators import mining, pairs
from distillery.plans import embedding, reranker
from distillery.session import ensure_checkpoint_dir
from distillery.sources import fixtures as fx
from distillery.sources import inputs as files
from distillery.sources import jsonl, ordering
from distillery.sources.tables import read_table

TOP_K, NUM_NEGATIVES, SEED = 8, 4, 7
SHARD_ROWS = 512


def _folder(spark: SparkSession) -> str:
    top = ensure_checkpoint_dir(spark)
    if top is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{top.rstrip('/')}/files-{uuid.uuid4().hex}"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored pairs of all conversations as JSONL lines with their order, some of them broken as
    logs are: by the passage's length, a line is cut short, lacks its score, or has NaN for it."""
    p = pairs.samples_to_pairs(fx.text_samples(spark, sf_dir), ["conv_id", "turn"])
    size = F.length("passage")
    record = F.to_json(F.struct("query", "passage", (size % 97 / F.lit(8.0)).alias("score")))
    bare = F.to_json(F.struct("query", "passage"))
    line = F.when(size % 11 == 3, F.left(record, F.length(record) - 3)).when(size % 13 == 5, bare).when(
        size % 17 == 7, F.concat(F.left(bare, F.length(bare) - 1), F.lit(',"score":NaN}'))).otherwise(record)
    side = F.when(F.col("side") == pairs.POSITIVE, F.lit(0)).otherwise(F.lit(1))
    return p.select("conv_id", "turn", side.alias("side_rank"), "pos", line.alias("value"))


def _written_pairs(spark: SparkSession, sf_dir: str) -> list[str]:
    """Two inputs of equal names, each in several part files: conversations by parity."""
    top = _folder(spark)
    order = ["conv_id", "turn", "side_rank", "pos"]
    out = []
    for name, odd in (("a", 0), ("b", 1)):
        path = f"{top}/{name}/train.jsonl"
        some = _lines(spark, sf_dir).filter(F.col("conv_id") % 2 == odd)
        some.repartitionByRange(3, *order).sortWithinPartitions(*order).select("value").write.text(path)
        out.append(path)
    return out


def _triplets(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    out = _folder(spark)
    reranker.create_triplet_files(spark, _written_pairs(spark, sf_dir), out, top_k=TOP_K, num_negatives=NUM_NEGATIVES, **how)
    rows = spark.read.schema("query string, positive string, negative string, score double, output string").json(out)
    return rows.select("output", F.md5("query").alias("query_md5"), F.md5("positive").alias("positive_md5"),
                       F.md5("negative").alias("negative_md5"), fix6("score").alias("score"))


def file_margin_triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored-pair files to triplet files, two inputs of equal names apart."""
    return _triplets(spark, sf_dir)


def file_random_triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with drawn negatives: the draw goes by line numbers."""
    return _triplets(spark, sf_dir, strategy="random", seed=SEED)


def file_triplet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines read, left out by reason, and triplets written, by input and in total."""
    return reranker.create_triplet_files(spark, _written_pairs(spark, sf_dir), _folder(spark), top_k=TOP_K,
                                         num_negatives=NUM_NEGATIVES)


def file_triplet_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each line of a triplet output, its part files read by name."""
    out = _folder(spark)
    reranker.create_triplet_files(spark, _written_pairs(spark, sf_dir), out, top_k=TOP_K, num_negatives=NUM_NEGATIVES)
    rows = jsonl.with_input_order(spark.read.schema(
        "query string, positive string, negative string, score double, output string").json(out))
    rows = ordering.with_line_numbers(rows, group=["output"])
    return rows.select("output", "line", F.md5("query").alias("query_md5"), F.md5("positive").alias("positive_md5"),
                       F.md5("negative").alias("negative_md5"))


def file_soft_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample files to soft-label files with a text embedder: triplets and distinct texts by
    input (S3, A4, U2, P3), read from gzipped JSONL (S6, S8)."""
    top = _folder(spark)
    s = fx.text_samples(spark, sf_dir)
    paths = []
    for name, odd in (("a", 0), ("b", 1)):
        paths.append(f"{top}/{name}/test.jsonl")
        s.filter(F.col("conv_id") % 2 == odd).select("query", "positive", "negative").write.option(
            "compression", "gzip").json(paths[-1])
    counts, missing = embedding.generate_soft_label_files(spark, paths, _folder(spark))
    return counts.withColumn("n_missing", F.lit(missing.count()).cast("long"))


def file_sample_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples written as gzipped JSONL in order, read strictly, with line numbers."""
    path = f"{_folder(spark)}/samples.jsonl"
    s = fx.text_samples(spark, sf_dir)
    ordering.in_file_order(s, ["conv_id", "turn"]).select("query", "positive", "negative").write.option(
        "compression", "gzip").json(path)
    rows = ordering.with_line_numbers(files.sample_inputs(spark, files.register(spark, path)), group=["input"])
    return rows.select("line", F.md5("query").alias("query_md5"), F.size("positive").cast("long").alias("n_positive"),
                       F.size("negative").cast("long").alias("n_negative"))


def training_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Margin triplets as training files of 512 rows, in order: each file's number by name, rows,
    and the first and last triplet's query (S10, S4, P9)."""
    path = _folder(spark)
    t = mining.mine_hard_negatives(fx.judged_vector_pairs(spark, sf_dir), ["qid"], "pid", "teacher", "seq", TOP_K, NUM_NEGATIVES)
    t = t.select("qid", "positive", "negative", F.col("score").cast("float").alias("score"), "pos_rank", "neg_rank")
    jsonl.write_training_shards(t, path, SHARD_ROWS, order=["qid", "pos_rank", "neg_rank"])
    rows = spark.read.schema("qid long, positive long, negative long, score float, pos_rank long, neg_rank long").json(path)
    per = rows.select("*", F.col("_metadata.file_name").alias("file")).groupBy("file").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("qid").alias("first_qid"), F.max("qid").alias("last_qid"))
    return ordering.with_row_numbers(per, ["file"], "shard").select("shard", "n_rows", "first_qid", "last_qid")


def output_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of outputs and metrics from page addresses."""
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url"])
    return pages.select("page_id", tf.suffixed_path("url", "_scored").alias("output"), tf.metric_name("url").alias("metric"))


def embedded_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector table after two fills with overlapping texts: a vector for each distinct text,
    however often it was asked for (U2, A4, J1)."""
    from distillery.sources.vectors import VectorStore

    store = VectorStore(spark, f"{_folder(spark)}/vectors")
    texts = embedding.sample_texts(fx.text_samples(spark, sf_dir))
    store.fill(texts.filter(F.length("text") % 2 == 0))
    store.fill(texts)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000000.0 + 0.5))
    return store.rows().select("digest", F.md5(F.array_join(whole.cast("array<string>"), ",")).alias("vector_md5"))


def score_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Softmax of each judged query's teacher scores, as arrays."""
    from distillery.functions.scoring import softmax_t

    p = fx.judged_vector_pairs(spark, sf_dir).groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("pid", "teacher"))).alias("c"))
    soft = softmax_t(F.transform("c", lambda x: x["teacher"]), 0.5)
    return p.select("qid", F.size("c").cast("long").alias("n"), F.posexplode(soft).alias("place", "p")).select(
        "qid", "n", F.col("place").cast("long").alias("place"), fix6("p").alias("p"))


QUERIES = {f.__name__: f for f in (
    file_margin_triplets, file_random_triplets, file_triplet_counts, file_triplet_order, file_soft_label_counts,
    file_sample_lines, training_shards, output_names, embedded_once, score_distribution)}
