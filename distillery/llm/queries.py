"""The registered queries of this subpackage: each applies its operator, with the parameters
of its contract, to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from distillery.llm import divergence_rules, line_windows, mixing
from distillery.llm.common import shared_folder, stored
from distillery.llm.divergence_rules import quality, word_references
from distillery.llm.language_id import held_out, identify, train
from distillery.llm.line_windows import dedup_lines
from distillery.llm.markov_secrets import find_secrets
from distillery.llm.markov_secrets import train as train_markov
from distillery.llm.mixing import mix
from distillery.llm.order_minhash import order_minhash
from distillery.llm.packing import pack_documents
from distillery.llm.prefix_forest import nearest
from distillery.llm.simhash_links import near_duplicates
from distillery.llm.token_alignment import align
from distillery.llm.token_counts import token_counts
from distillery.llm.warc import read_warc, transactions, write_warc
from distillery.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs, ~held_out())
    return identify(docs, model, keep=["doc_id"]).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "spans")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    write_warc(_table(spark, sf_dir, "pages"), folder)
    captures = transactions(stored(read_warc(spark, folder, payload=False)))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), memo_pieces=1_000_000)


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"))


def op7_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(rows, F.col("vec_id") % 20 == 0)


def op8_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_secrets(docs, train_markov(docs))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality(docs, stored(word_references(docs)))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_language_id, op3_warc, op4_packing, op5_order_minhash, op6_mixing, op7_prefix_forest,
    op8_line_windows, op9_secrets, op10_simhash, op11_divergence, op12_whitening, op13_alignment)}

ORACLES = {
    "op3_warc": """
SELECT page_id, payload_bytes, payload_digest, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN last END AS refers_to
FROM (SELECT *, payload_bytes >= 1000 AND copies > 1 AND page_id IS DISTINCT FROM last AS revisit
      FROM (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
                   max(page_id) OVER w AS last, count(*) OVER w AS copies
            FROM pages WINDOW w AS (PARTITION BY coalesce(html, ''))))
""",
    "op6_mixing": mixing.ORACLE,
    "op8_line_windows": line_windows.ORACLE,
    "op11_divergence": divergence_rules.ORACLE,
}
