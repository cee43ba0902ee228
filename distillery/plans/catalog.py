"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``
over the whole driver tables. Column names match the oracle SQL in
:mod:`distillery.plans.oracle`. Long texts are reported as ``md5`` + length."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from distillery.functions import text as tf
from distillery.functions.numeric import fix6
from distillery.operators import losses, metrics, mining, pairs, report, stats, teacher
from distillery.plans import embedding, file_queries
from distillery.session import materialize
from distillery.sources import fixtures as fx

TOP_K = 8
NUM_NEGATIVES = 4
RANDOM_SEED = 42
EVAL_K = 10
KL_TEMPERATURES = (1.0, 2.0)
STUDENTS = ("before", "after")
TEACHER_INSTRUCTION = "Given a user turn, retrieve the reply that answers it"
TEACHER_MAX_LENGTH = 400
TEACHER_BATCH = 8
#: Queries with a label up to this are one query in the hot-query evaluation (near a third of all).
HOT_MAX_LABEL = 2
HOT_RANGE_LEVELS = 2_000


# ---- vector-judged pairs (reranker / embedding distillation core) ---------------------

def pair_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.judged_vector_pairs(spark, sf_dir).select(
        "qid", "pid", "rel", "side", "domain", "teacher", "before", "after"
    )


def _hard(spark, sf_dir, carry=(), group=("qid",), first_seen=False):
    return mining.mine_hard_negatives(
        fx.judged_vector_pairs(spark, sf_dir), list(group), "pid", "teacher", "seq",
        top_k=TOP_K, num_negatives=NUM_NEGATIVES, carry_cols=carry, first_seen=first_seen,
    )


def hard_negative_triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hard(spark, sf_dir)


def hard_negative_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hard(spark, sf_dir, first_seen=True).orderBy("first_seen", "pos_rank", "neg_rank")


def random_negative_triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    # scored once: the miner reads its input three times
    scored = materialize(fx.judged_vector_pairs(spark, sf_dir).select("qid", "pid", "teacher", "seq"))
    return mining.mine_random_negatives(
        scored, ["qid"], "pid", "teacher", "seq", top_k=TOP_K, num_negatives=NUM_NEGATIVES, seed=RANDOM_SEED,
    )


def training_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _hard(spark, sf_dir)
    return t.select("qid", "positive", "negative", F.col("score").cast("float").alias("score"))


def training_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.preview(_hard(spark, sf_dir), ["qid", "pos_rank", "neg_rank"])


def triplet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.triplet_counts(_hard(spark, sf_dir, group=("domain", "qid")), ["domain"])


def soft_label_triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.judged_vector_pairs(spark, sf_dir)
    # a query has at most CANDIDATE_WINDOW candidates
    t = pairs.cross_sides(p, ["qid"], id_cols=["pid"], carry_cols=["teacher"], block_rows=None)
    return t.select(
        "qid", F.col("pid_pos").alias("positive"), F.col("pid_neg").alias("negative"),
        F.col("teacher_pos").alias("label_pos"), F.col("teacher_neg").alias("label_neg"),
    )


def yes_no_logit(spark: SparkSession, sf_dir: str) -> DataFrame:
    lp = fx.teacher_logprobs(fx.judged_vector_pairs(spark, sf_dir))
    scored = teacher.teacher_from_logprobs(lp, "logprobs", "logit")
    return scored.select("qid", "pid", F.size("logprobs").cast("long").alias("n_tokens"), "logit")


def score_pairs_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    cand = fx.vector_pair_candidates(spark, sf_dir)
    return teacher.score_pairs(
        cand.select("qid", "pid", "q_v", "p_v"),
        teacher.numpy_cosine_scorer(["qid", "pid"], "q_v", "p_v", "teacher"),
        "qid long, pid long, teacher double",
    )


# ---- evaluation ------------------------------------------------------------------------

def _per_query(spark, sf_dir, metric: str, out: str):
    p = fx.judged_vector_pairs(spark, sf_dir)
    long = metrics.models_long(p, ["qid", "domain", "rel", "seq"], ["teacher", *STUDENTS])
    pq = metrics.per_query_metrics(long, ["model", "qid"], k=EVAL_K, empty_side="zero")
    return pq.select("model", "qid", fix6(metric).alias(out))


def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_query(spark, sf_dir, "ap", "ap")


def rr_at_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_query(spark, sf_dir, "rr", "rr_at_10")


def ndcg_at_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_query(spark, sf_dir, "ndcg", "ndcg_at_10")


def _report(spark, sf_dir):
    p = fx.judged_vector_pairs(spark, sf_dir)
    return metrics.rerank_report(p, STUDENTS, k=EVAL_K, empty_side="drop")


def rerank_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).select("domain", "model", "metric", fix6("value").alias("value"))


def compare_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rep = _report(spark, sf_dir).withColumn("value", fix6("value"))
    cmp = report.format_report(report.compare_runs(rep, "before", "after", zero_base="inf"), "reranker")
    return cmp.select(
        "domain", "metric", "before", "after",
        fix6("abs_change").alias("abs_change"), fix6("rel_change").alias("rel_change"),
        "direction", "metric_label", "before_text", "after_text", "abs_text", "rel_text",
    )


def margin_mse(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _hard(spark, sf_dir, carry=STUDENTS)
    # one aggregation pass computes every model's loss, then unpivot to rows
    wide = losses.margin_mse_wide(t, {m: (f"{m}_pos", f"{m}_neg") for m in STUDENTS}, "score")
    out = wide.unpivot(["n"], list(STUDENTS), "model", "loss")
    return out.select("model", fix6("loss").alias("loss"), "n")


def distill_kl(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.judged_vector_pairs(spark, sf_dir)
    t = pairs.cross_sides(p, ["qid"], id_cols=["pid"], carry_cols=["teacher", *STUDENTS], block_rows=None)
    variants = {
        f"{m}|{round(temp * 1000)}": (f"{m}_pos", f"{m}_neg", temp) for m in STUDENTS for temp in KL_TEMPERATURES
    }
    wide = losses.distill_kl_wide(t, "teacher_pos", "teacher_neg", variants)
    long = wide.unpivot(["n"], list(variants), "variant", "loss")
    parts = F.split("variant", "[|]")
    return long.select(
        parts[0].alias("model"), (parts[1].cast("double") / F.lit(1000.0)).alias("temperature"), fix6("loss").alias("loss"), "n"
    )


def hot_query_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank metrics where one query has about a third of all candidates: the judged pairs of
    all queries with a small label are pooled into one. Ranked in ranges at sampled quantiles,
    never whole in one task."""
    p = materialize(fx.judged_vector_pairs(spark, sf_dir).select(
        F.when(F.col("qlabel") <= HOT_MAX_LABEL, F.lit(-1)).otherwise(F.col("qid")).alias("query"), "rel", "teacher",
        F.struct("qid", "pid").alias("at")))
    m = metrics.per_query_metrics(p, ["query"], "teacher", "rel", "at", k=EVAL_K, empty_side="zero", method="split",
                                  range_levels=HOT_RANGE_LEVELS)
    return m.select("query", "n_cand", "n_rel", fix6("ap").alias("ap"), fix6("rr").alias("rr"), fix6("ndcg").alias("ndcg"))


# ---- text samples (conversations) ------------------------------------------------------

def _text_pairs(spark, sf_dir):
    return pairs.samples_to_pairs(fx.text_samples(spark, sf_dir), ["conv_id", "turn"])


def samples_to_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_pairs(spark, sf_dir).select(
        "conv_id", "turn", "side", "pos", "rel",
        F.md5("query").alias("query_md5"), F.md5("passage").alias("passage_md5"),
        F.length("passage").cast("long").alias("passage_chars"),
    )


def _truthy(spark, sf_dir):
    s = fx.text_samples(spark, sf_dir)
    return s.filter(tf.all_truthy(strings=["query"], arrays=["positive", "negative"]))


def truthy_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _truthy(spark, sf_dir).select(
        "conv_id", "turn", F.md5("query").alias("query_md5"),
        F.size("positive").cast("long").alias("n_positive"), F.size("negative").cast("long").alias("n_negative"),
    )


def distinct_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pairs.distinct_texts(_truthy(spark, sf_dir))
    return d.select(F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_chars"), "occurrences")


def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.dataset_stats(fx.text_samples(spark, sf_dir))


def prompt_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _text_pairs(spark, sf_dir).withColumn("messages", tf.rerank_messages("query", "passage"))
    return m.select(
        "conv_id", "turn", "side", "pos",
        F.size("messages").cast("long").alias("n_messages"),
        F.md5(F.col("messages")[0]["content"]).alias("system_md5"),
        F.col("messages")[1]["role"].alias("user_role"),
        F.md5(F.col("messages")[1]["content"]).alias("user_md5"),
        F.length(F.col("messages")[1]["content"]).cast("long").alias("user_chars"),
    )


def truncate_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt token ids of whole document pairs (long texts): the whole chat template, cut to
    the teacher's default limit (8,192) and followed by the assistant suffix. Reported: the full
    prompt length, the kept length, a digest of all ids, and the ids at the head, at the seam
    between the kept prompt and the suffix, and at the tail. An id is a code point, so what a
    prompt keeps depends on no more than that many characters of its texts: the rest is known
    by its length alone and isn't moved."""
    limit = tf.DEFAULT_MAX_TOKENS
    p = pairs.samples_to_pairs(fx.document_heads(spark, sf_dir, limit), ["doc_id"])
    prompt = F.left(tf.rerank_template("query.head", "passage.head"), F.lit(limit))
    frame = F.length(tf.rerank_template(F.lit(""), F.lit("")))
    suffix = tf.suffix_token_ids()
    t = p.select(
        "doc_id", "side", "pos",
        (frame + F.col("query.n_chars") + F.col("passage.n_chars")).alias("n_prompt"), prompt.alias("prompt"),
    ).select(
        "doc_id", "side", "pos", "n_prompt",
        tf.truncate_with_suffix(tf.char_token_ids("prompt"), limit, suffix).alias("ids"),
    ).withColumn("n_ids", F.size("ids").cast("long"))
    seam = F.greatest(F.col("n_ids") - F.lit(len(suffix) + 3), F.lit(1))
    return t.select(
        "doc_id", "side", "pos", "n_prompt", "n_ids",
        tf.ids_md5("ids").alias("ids_md5"),
        F.array_join(F.slice("ids", 1, 8), ",").alias("head_ids"),
        F.array_join(F.slice("ids", seam, F.lit(8)), ",").alias("seam_ids"),
        F.array_join(F.slice("ids", -4, 4), ",").alias("tail_ids"),
    )


def teacher_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From samples to log-odds: pairs, the prompt with an instruction, token ids cut to a
    maximum length, length-batched scoring by a (stand-in) one-token teacher."""
    p = _text_pairs(spark, sf_dir).withColumn("prompt", tf.rerank_template("query", "passage", TEACHER_INSTRUCTION))
    return teacher.score_prompts(p, teacher.stand_in_teacher, ["conv_id", "turn", "side", "pos"],
                                 max_length=TEACHER_MAX_LENGTH, batch_size=TEACHER_BATCH, out_col="logit")


# ---- text -> vector table (documents x embeddings) -------------------------------------

def text_vector_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    tv = fx.text_vectors(spark, sf_dir)
    return tv.select(F.md5("text").alias("text_md5"), "vec_id", "n_rows")


def missing_vector_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text has no vector (P8's report): an anti-join by exact text
    against the text -> vector table (a text with many copies is a skewed key of the
    anti-join, which AQE splits on the document side)."""
    docs = fx.read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    tv = fx.text_vectors(spark, sf_dir).select("text")
    missing = docs.join(tv, "text", "left_anti")
    return missing.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_chars"))


def embed_texts_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pairs.distinct_texts(_truthy(spark, sf_dir))
    e = teacher.embed_texts(d, text_col="text")
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000000.0 + 0.5))
    return e.select(F.md5("text").alias("text_md5"), F.size("embedding").cast("long").alias("dim"),
                    F.md5(F.array_join(whole.cast("array<string>"), ",")).alias("vector_md5"))


# ---- documents: embedding pipeline on whole texts ---------------------------------------

def _doc_triplets(spark, sf_dir):
    """Embedding pipeline on document ids: vectors are looked up through the document
    index (exact text -> vector), so no text crosses a shuffle after the index."""
    samples = fx.document_sample_ids(spark, sf_dir)
    idx = fx.document_index(spark, sf_dir)
    return embedding.soft_label_triplets(samples, idx, "doc_id", "embedding", keys=["doc_id"], query_col="doc_id",
                                         block_rows=None)  # three candidates a sample


def _with_md5(df: DataFrame, spark, sf_dir, id_col: str, out: str) -> DataFrame:
    idx = fx.document_index(spark, sf_dir).select(F.col("doc_id").alias(id_col), F.col("text_md5").alias(out))
    return df.join(idx, id_col, "inner")


def document_soft_label_triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = _doc_triplets(spark, sf_dir)
    scored = _with_md5(scored, spark, sf_dir, "negative", "negative_md5")
    return scored.select(
        "doc_id", "pos_index", "neg_index", "negative_md5",
        F.col("label")[0].alias("label_pos"), F.col("label")[1].alias("label_neg"),
    )


def document_missing_triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, missing = _doc_triplets(spark, sf_dir)
    missing = _with_md5(missing, spark, sf_dir, "negative", "negative_md5")
    return missing.select("doc_id", "pos_index", "neg_index", "negative_md5")


def document_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mining grouped by the query *text* (its exact-text key): document copies merge
    their candidates, as lines sharing a query string do in a scored-pair file. Text
    identity and md5 come from the document index and ride through the miner, so no
    text and no extra join follows the window."""
    idx = fx.document_index(spark, sf_dir)
    p = pairs.samples_to_pairs(fx.document_sample_ids(spark, sf_dir), ["doc_id"], query_col="doc_id")
    vec = teacher.prepare_vectors(idx.filter(F.col("embedding").isNotNull()), "doc_id")
    scored = teacher.score_pairs_cosine(p, vec, "query", "passage", "score", how="left")
    q_keys = idx.select(F.col("doc_id").alias("query"), F.col("text_key").alias("query_key"),
                        F.col("text_md5").alias("query_md5"))
    p_keys = idx.select(F.col("doc_id").alias("passage"), F.col("text_key").alias("passage_key"),
                        F.col("text_md5").alias("md5"))
    scored = scored.join(q_keys, "query").join(p_keys, "passage")
    side = F.when(F.col("side") == pairs.POSITIVE, F.lit(0)).otherwise(F.lit(1))
    scored = scored.withColumn("seq", F.struct("doc_id", side.alias("side"), F.col("pos")))
    t = mining.mine_hard_negatives(scored, ["query_key", "query_md5"], "passage_key", "score", "seq",
                                   TOP_K, NUM_NEGATIVES, carry_cols=["md5"])
    return t.select(
        "query_md5", F.col("md5_pos").alias("positive_md5"), F.col("md5_neg").alias("negative_md5"),
        "pos_rank", "neg_rank", "score",
    )


QUERIES = {
    "pair_cosine": pair_cosine,
    "hard_negative_triplets": hard_negative_triplets,
    "hard_negative_first_seen": hard_negative_first_seen,
    "random_negative_triplets": random_negative_triplets,
    "training_export": training_export,
    "training_preview": training_preview,
    "triplet_counts": triplet_counts,
    "soft_label_triplets": soft_label_triplets,
    "yes_no_logit": yes_no_logit,
    "score_pairs_pandas": score_pairs_pandas,
    "average_precision": average_precision,
    "rr_at_10": rr_at_10,
    "ndcg_at_10": ndcg_at_10,
    "rerank_report": rerank_report,
    "compare_runs": compare_runs,
    "margin_mse": margin_mse,
    "distill_kl": distill_kl,
    "hot_query_metrics": hot_query_metrics,
    "samples_to_pairs": samples_to_pairs,
    "truthy_samples": truthy_samples,
    "distinct_texts": distinct_texts,
    "dataset_stats": dataset_stats,
    "prompt_messages": prompt_messages,
    "truncate_suffix": truncate_suffix,
    "teacher_logits": teacher_logits,
    "text_vector_table": text_vector_table,
    "missing_vector_report": missing_vector_report,
    "embed_texts_pandas": embed_texts_pandas,
    "document_soft_label_triplets": document_soft_label_triplets,
    "document_missing_triplets": document_missing_triplets,
    "document_hard_negatives": document_hard_negatives,
} | file_queries.QUERIES
