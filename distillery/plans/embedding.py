"""Embedding distillation pipeline: samples -> distinct texts -> vectors -> pair cosines ->
positive x negative soft-label triplets.

Cosine depends only on the (query, passage) pair, so it is computed per pair (P + N per
sample) and only then crossed into P x N triplets; vectors never enter the product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distillery.operators import pairs, teacher
from distillery.session import materialize
from distillery.sources import inputs as files
from distillery.sources.vectors import VectorStore, address

KEYS = ["source_file", "seq"]


def soft_label_triplets(samples: DataFrame, vectors: DataFrame, text_col: str = "text",
                        vec_col: str = "embedding", keys=KEYS, query_col: str = "query",
                        block_rows: int | None = pairs.BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """``(scored, missing)``: scored rows ``*keys, query, positive, negative, label``
    (``label = [cos(q, pos), cos(q, neg)]``); ``missing`` lists triplets where any of the
    three has no vector. ``samples`` should already be truthy-filtered. Queries and
    passages may be texts or ids: ``vectors`` is keyed by ``text_col`` accordingly
    (keying by id lets texts stay out of every shuffle)."""
    keys = list(keys)
    p = pairs.samples_to_pairs(samples, keys, query_col=query_col)
    return label_pairs(p, vectors, keys, text_col, vec_col, block_rows)


def label_pairs(p: DataFrame, vectors: DataFrame, keys, key_col: str = "text",
                vec_col: str = "embedding", block_rows: int | None = pairs.BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Pair cosines, then the positive x negative product per sample (see module doc)."""
    vec = teacher.prepare_vectors(vectors.filter(F.col(vec_col).isNotNull()), key_col, vec_col)
    scored = teacher.score_pairs_cosine(p, vec, "query", "passage", "score", how="left")
    trip = pairs.cross_sides(scored, keys, id_cols=["pos", "passage"], carry_cols=["score", "query"], block_rows=block_rows)
    out = trip.select(
        *keys, F.col("query_pos").alias("query"),
        F.col("passage_pos").alias("positive"), F.col("passage_neg").alias("negative"),
        F.col("pos_pos").alias("pos_index"), F.col("pos_neg").alias("neg_index"),
        F.array(F.col("score_pos"), F.col("score_neg")).alias("label"),
    )
    ok = F.col("label")[0].isNotNull() & F.col("label")[1].isNotNull()
    return out.filter(ok), out.filter(~ok).drop("label")


def sample_texts(samples: DataFrame, keep=()) -> DataFrame:
    """Every text of the samples (``text``, with the columns ``keep``): query, positives, negatives."""
    lists = [F.coalesce(F.col(c), F.array().cast("array<string>")) for c in ("positive", "negative")]
    return samples.select(*keep, F.explode(F.concat(F.array("query"), *lists)).alias("text")).filter("text is not null")


def embed_and_label(samples: DataFrame, embedder=None, store: VectorStore | None = None, keys=KEYS) -> tuple[DataFrame, DataFrame]:
    """Embed every distinct text once (those that the ``store`` doesn't hold yet), then label the
    triplets: ``(scored, missing)`` as of :func:`soft_label_triplets`.

    Vectors are looked up by content address and the pairs' cosines computed once, for scored
    and missing triplets alike. The product is made of list positions; texts join it at the end,
    by sample."""
    keys = list(keys)
    store = store or VectorStore(samples.sparkSession)
    store.fill(sample_texts(samples), embedder)
    vec = teacher.prepare_vectors(store.table(), "digest")
    p = pairs.samples_to_pairs(samples, keys)
    p = p.select(*keys, "side", "pos", address("query").alias("query"), address("passage").alias("passage"))
    scored = materialize(teacher.score_pairs_cosine(p, vec, "query", "passage", "score", how="left").select(
        *keys, "side", "pos", "score"))
    trip = pairs.cross_sides(scored, keys, id_cols=["pos"], carry_cols=["score"])
    texts = samples.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("query"), F.col("positive").alias("_p"),
                           F.col("negative").alias("_n"))
    same = F.lit(True)
    for k in keys:
        same = same & trip[k].eqNullSafe(texts[f"_{k}"])
    out = trip.join(texts, same).select(
        *keys, "query", F.get("_p", F.col("pos_pos")).alias("positive"), F.get("_n", F.col("pos_neg")).alias("negative"),
        F.col("pos_pos").alias("pos_index"), F.col("pos_neg").alias("neg_index"),
        F.array(F.col("score_pos"), F.col("score_neg")).alias("label"))
    ok = F.col("label")[0].isNotNull() & F.col("label")[1].isNotNull()
    return out.filter(ok), out.filter(~ok).drop("label")


def soft_label_records(scored: DataFrame) -> DataFrame:
    """The training contract ``query, positive, negative, label array<float>``."""
    return scored.select("query", "positive", "negative", F.col("label").cast("array<float>").alias("label"))


def generate_soft_label_files(spark, inputs, output_dir: str, embedder=None, suffix: str = "_soft_labels",
                              store: VectorStore | None = None, ordered: bool = True, on_clash: str = "path"):
    """Soft-label stage over sample files: truthy read, embed every distinct text once, label
    all positive x negative triplets, write one output per input, in input order
    (``ordered``). Returns ``(counts, missing-vector triplets)``; the counts have, for every
    input and in total, ``output, n_triplets`` and ``n_texts`` (distinct texts; those of the
    total are distinct within each input)."""
    found = files.register(spark, inputs, suffix, on_clash=on_clash)
    if not found:
        none = spark.createDataFrame([], "source_file string, query string, positive string, negative string")
        return spark.createDataFrame([(None, 0, 0)], "output string, n_triplets long, n_texts long"), none
    tally = files.Tally(found)
    samples = files.sample_inputs(spark, found, "truthy")
    keys = ["input", *KEYS]
    scored, missing = embed_and_label(samples, embedder, store, keys)
    records = scored.withColumn("label", F.col("label").cast("array<float>"))
    files.write_outputs(records, found, output_dir, [*KEYS, "pos_index", "neg_index"],
                        ["query", "positive", "negative", "label"], tally, "n_triplets", ordered)
    texts = sample_texts(samples, ["input"]).select("input", address("text").alias("digest")).distinct()
    per = texts.groupBy("input").agg(F.count(F.lit(1)).alias("n_texts"))
    names = spark.createDataFrame([(x.number, x.output) for x in found], "number int, name string")
    per = names.join(per, names["number"] == per["input"], "left").select(
        "name", F.coalesce("n_texts", F.lit(0)).alias("n_texts"))
    per = per.unionByName(per.agg(F.lit(None).cast("string").alias("name"), F.coalesce(
        F.sum("n_texts"), F.lit(0)).alias("n_texts")))
    counts = tally.frame(spark).select("output", "n_triplets")
    return counts.join(per, F.col("output").eqNullSafe(F.col("name"))).select("output", "n_triplets", "n_texts"), missing
