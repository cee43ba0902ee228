"""Reranker distillation pipeline: samples -> pairs -> teacher score -> margin triplets.

Every stage is one lazy plan; stages meet through JSONL (or any table) only where a
pipeline is split across jobs, which is also the lineage cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from distillery.functions.text import DEFAULT_INSTRUCTION, DEFAULT_MAX_TOKENS, rerank_template
from distillery.operators import mining, pairs, teacher
from distillery.session import materialize
from distillery.sources import inputs as files
from distillery.sources import jsonl, ordering

PAIR_KEYS = ["source_file", "seq"]


def sample_pairs(samples: DataFrame, keys=PAIR_KEYS) -> DataFrame:
    """Pairs of JSONL samples keyed by ``(source_file, seq, side, pos)``; ``pair_seq`` is
    the pair's input order (sample order, then positives before negatives, list order)."""
    p = pairs.samples_to_pairs(samples, list(keys))
    side_rank = F.when(F.col("side") == pairs.POSITIVE, F.lit(0)).otherwise(F.lit(1))
    return p.withColumn("pair_seq", F.struct(F.col("seq"), side_rank.alias("side"), F.col("pos").alias("pos")))


def score_with_logprobs(pair_df: DataFrame, logprobs: DataFrame, keys: list[str]) -> DataFrame:
    """Teacher scores that arrive as yes/no log-probability maps keyed like the pairs."""
    return teacher.teacher_from_logprobs(pair_df.join(logprobs, keys, "inner"), "logprobs", "score")


def scored_pair_records(scored: DataFrame) -> DataFrame:
    """The scored-pair contract ``query, passage, score`` (+ source/order columns)."""
    return scored.select("query", "passage", "score", "source_file", F.col("pair_seq").alias("seq"))


def margin_triplets(
    scored_pairs: DataFrame, top_k: int = 8, num_negatives: int = 4, strategy: str = "hard", seed: int = 0,
    ordered: bool = False,
) -> DataFrame:
    """Mine triplets per (input, query); queries of different inputs never merge. Rows of
    registered inputs carry their ``input``; without it, a ``source_file`` is an input, and the
    part files of one stage output (``.../output=<name>/part-*``) are one, ordered by part.
    Output ``source_file`` (or ``input``)``, query, positive, negative, pos_rank, score`` (hard: and
    ``neg_rank``), sorted by the query's first row with ``ordered``."""
    t = _mined(scored_pairs, top_k, num_negatives, strategy, seed, ordered)
    if ordered:
        t = t.orderBy(t.columns[0], "first_seen", "pos_rank", "neg_order")
    return t.drop("neg_order")


def _mined(scored_pairs, top_k, num_negatives, strategy, seed, first_seen) -> DataFrame:
    """The triplets, with ``neg_order`` (the order of a positive's negatives) and, if asked for,
    ``first_seen``, the place of the query's first row."""
    name = "input" if "input" in scored_pairs.columns else "source_file"
    rows = scored_pairs
    if strategy == "random":
        # a draw must not know how the files were split for reading: rows go by line numbers
        stage = F.regexp_replace("source_file", r"(/output=[^/]+)/[^/]*$", "$1/all")
        rows = rows if name == "input" else rows.withColumn("_whole", stage)
        rows = ordering.with_line_numbers(rows, "source_file", "seq", "_line", ["input" if name == "input" else "_whole"],
                                          filtered="reason" not in rows.columns)
        rows = rows.withColumn("seq", F.col("_line"))
    else:
        rows = rows.withColumn("seq", F.struct(F.col("source_file").alias("file"), F.col("seq").alias("at")))
    if name == "source_file":
        rows = rows.withColumn("source_file", F.regexp_replace("source_file", r"(/output=[^/]+)/[^/]*$", "$1/all"))
    if "reason" in rows.columns:
        rows = rows.filter(F.col("reason").isNull())
    rows = rows.select(name, "query", "passage", "score", "seq")
    group = [name, "query"]
    if strategy == "hard":
        return mining.mine_hard_negatives(rows, group, "passage", "score", "seq", top_k, num_negatives,
                                          first_seen=first_seen).withColumn("neg_order", F.col("neg_rank"))
    if strategy != "random":
        raise ValueError("strategy must be 'hard' or 'random'")
    keyed = materialize(rows.withColumn("_qkey", F.concat_ws("\u0001", F.col(name).cast("string"), "query")))
    t = mining.mine_random_negatives(keyed, ["_qkey"], "passage", "score", "seq", top_k, num_negatives, seed,
                                     carry_cols=[name, "query"])
    t = t.select(F.col(f"{name}_pos").alias(name), F.col("query_pos").alias("query"), "positive", "negative",
                 "pos_rank", "score", F.col("neg_seq").alias("neg_order"))
    if first_seen:
        t = t.join(keyed.groupBy(*group).agg(F.min("seq").alias("first_seen")), group)
    return t


def generate_scored_pair_files(
    spark: SparkSession, inputs, output_dir: str, scorer, suffix: str = "_scored", ordered: bool = True,
    on_clash: str = "path", teacher_loader=None, tokenizer=None, batch_size: int = 8, max_length: int = DEFAULT_MAX_TOKENS,
    instruction: str = DEFAULT_INSTRUCTION,
) -> DataFrame:
    """Teacher stage over sample files: flatten every sample (strict read), score each
    (query, passage) with a batch scorer ``(queries: pd.Series, passages: pd.Series) ->
    array`` through ``mapInPandas``, and write one scored-pair output per input. With a
    ``teacher_loader`` instead, the scores are the log-odds of a one-token teacher on the whole
    prompt with ``instruction`` (see :func:`teacher.score_prompts`). With
    ``ordered``, pairs are dealt by ranges of their input order before they are scored, so
    that an output's part files, read by name, are in that order and no pair is scored twice.
    Returns ``output, n_pairs`` of every input, and the total."""
    from distillery.plans.evaluation import score_inline

    found = files.register(spark, inputs, suffix, on_clash=on_clash)
    if not found:
        return spark.createDataFrame([(None, 0)], "output string, n_pairs long")
    tally = files.Tally(found)
    p = sample_pairs(files.sample_inputs(spark, found), ["input", *PAIR_KEYS])
    p = p.withColumn("output", files.output_of(found))
    if ordered:
        p = ordering.in_file_order(p, ["source_file", "pair_seq"], ["output"])
    # everything the output needs rides through the scorer's Arrow batches: one pass
    keep = ["output", "input", "query", "passage"]
    if teacher_loader is None:
        records = score_inline(p, {"score": scorer}, keep=keep)
    else:
        records = teacher.score_prompts(
            p.withColumn("prompt", rerank_template("query", "passage", instruction)), teacher_loader, keep,
            max_length=max_length, batch_size=batch_size, tokenizer=tokenizer or teacher.code_point_tokenizer)
    jsonl.write_jsonl(tally.written(records, "n_pairs").select("query", "passage", "score", "output"), output_dir,
                      partition_by=["output"])
    return tally.frame(spark).select("output", "n_pairs")


def create_triplet_files(
    spark: SparkSession, inputs, output_dir: str, suffix: str = "_margin_sampled", top_k: int = 8,
    num_negatives: int = 4, strategy: str = "hard", seed: int = 0, ordered: bool = True, on_clash: str = "path",
    quarantine_dir: str | None = None,
) -> DataFrame:
    """Read scored-pair JSONL inputs (lenient) and write one triplet output per input, in the
    order in which its queries are first seen (``ordered``). Returns, for every input and in
    total, ``output, n_triplets``, the lines read, and those left out by reason; the last are
    written to ``quarantine_dir`` if there is one."""
    found = files.register(spark, inputs, suffix, on_clash=on_clash)
    if not found:
        names = ("n_triplets", "n_lines", "n_malformed", "n_missing", "n_nan")
        return spark.createDataFrame([(None, *[0] * 5)], ", ".join(["output string", *[f"{n} long" for n in names]]))
    tally = files.Tally(found)
    rows = files.pair_inputs(spark, found, tally)
    trip = _mined(rows, top_k, num_negatives, strategy, seed, ordered)
    files.write_outputs(trip, found, output_dir, ["first_seen", "pos_rank", "neg_order"],
                        ["query", "positive", "negative", "score"], tally, "n_triplets", ordered)
    if quarantine_dir is not None:
        left = files.pair_inputs(spark, found).filter("reason is not null")
        left = left.withColumn("output", files.output_of(found)).select(
            "output", "source_file", "reason", "record", "query", "passage", "score")
        left.withColumn("score", F.col("score").cast("string")).write.mode("overwrite").option(
            "ignoreNullFields", "false").json(quarantine_dir)
    return tally.frame(spark).select("output", "n_triplets", F.col("n_rows").alias("n_lines"), "n_malformed", "n_missing", "n_nan")
