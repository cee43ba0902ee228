"""The corpus pipeline: five stages over ``documents``, each calling one operator of
``distillery.llm``. Every stage but the last returns the columns it got; the next one reads
them from Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from distillery.llm.common import stored
from distillery.llm.language_id import identify, train
from distillery.llm.line_windows import dedup_lines
from distillery.llm.mixing import mix
from distillery.llm.packing import pack_documents
from distillery.llm.simhash_links import drop_near_duplicates

#: A document is kept if one language holds at least this share of its letters.
MIN_SHARE = 0.5
#: Pieces that a packing worker remembers: its executor also holds what other stages have left.
MEMO_PIECES = 150_000


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter (null and empty ones too) and those in which no
    language labels half of the letters. The model learns from the stage's own labelled rows."""
    model = train(docs, F.lit(True))
    columns = docs.columns
    if not model.langs:  # nothing can be told, and nothing rejected for it, without a labelled row
        return docs
    named = docs.select(*[F.col(c).alias(f"d{i}") for i, c in enumerate(columns)])
    found = identify(named, model, text=f"d{columns.index('text')}", keep=named.columns, spans=False, least=MIN_SHARE)
    return found.select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(columns)])


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated three-line windows; ``n_chars`` is counted again."""
    out = dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(out.columns[-1]) > 0, F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: that of the smallest doc_id (nulls last). Texts
    without a word, null ones too, are one group."""
    return drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: its taken words in whole copies, a half or
    more counting as one. Documents without words are never taken."""
    columns = docs.columns
    named = docs.select(*[F.col(c).alias(f"d{i}") for i, c in enumerate(columns)])
    at = lambda c: f"d{columns.index(c)}"
    mixed = mix(named, at("doc_id"), at("text"), at("source"), keep=named.columns)
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    return mixed.filter((F.col("size") > 0) & (F.col("taken") * 2 >= F.col("size"))).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), copies))).select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(columns)])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents' sequences; a null text is empty, repeated rows are packed each."""
    return pack_documents(docs, memo_pieces=MEMO_PIECES)


STAGES = [("language ID", language_stage), ("line dedup", line_stage), ("SimHash near-dedup", near_duplicate_stage),
          ("mixing sources to target weights", mixing_stage), ("packing", packing_stage)]

#: Language models and XXH64 fingerprints can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
