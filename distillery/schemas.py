"""Explicit schemas of every record kind (never inferred on read)."""

from pyspark.sql.types import (
    ArrayType, DoubleType, FloatType, LongType, MapType, StringType, StructField, StructType,
)

CORRUPT_COL = "_corrupt_record"

# reranking sample: a query with its relevant and irrelevant passages
SAMPLE = StructType([
    StructField("query", StringType()),
    StructField("positive", ArrayType(StringType())),
    StructField("negative", ArrayType(StringType())),
])

# teacher-scored (query, passage) pair
SCORED_PAIR = StructType([
    StructField("query", StringType()),
    StructField("passage", StringType()),
    StructField("score", DoubleType()),
])

# margin triplet; score = teacher margin (float32 at training export)
MARGIN_TRIPLET = StructType([
    StructField("query", StringType()),
    StructField("positive", StringType()),
    StructField("negative", StringType()),
    StructField("score", DoubleType()),
])

# soft-label triplet; label = [sim(query, positive), sim(query, negative)]
SOFT_TRIPLET = StructType([
    StructField("query", StringType()),
    StructField("positive", StringType()),
    StructField("negative", StringType()),
    StructField("label", ArrayType(DoubleType())),
])

# teacher yes/no log-probabilities per pair
LOGPROBS = StructType([
    StructField("pair_id", LongType()),
    StructField("logprobs", MapType(StringType(), DoubleType())),
])

# long metric table
METRIC = StructType([
    StructField("domain", StringType()),
    StructField("model", StringType()),
    StructField("metric", StringType()),
    StructField("value", DoubleType()),
])

TRAINING_SCORE_TYPE = FloatType()


def with_corrupt(schema: StructType) -> StructType:
    return StructType(schema.fields + [StructField(CORRUPT_COL, StringType())])
