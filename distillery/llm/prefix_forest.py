"""Nearest neighbours by inner product with a hash-prefix forest.

Each of several trees gives every vector a string of 64 sign bits (random hyperplanes, over
vectors lengthened to a common norm, so that angle order is inner-product order). A tree is
the sorted array of these strings; its node at depth x is a run of equal x-bit prefixes.

A query descends to a depth at which nodes hold few rows and scores the rows there, in all
trees. Then all trees ascend together, each query to its own prefix length: the longest
depth x at which a neighbour as near as its worst one so far would be missed by all trees
with probability ``1 - target`` at most, (1 - p^x)^trees with p = 1 - angle / pi. Clustered
data stops deep; data without structure ascends almost to the root, as it must.

Equal vectors are one row of the index; a run that is too long for one task is scored in
chunks, and its queries, if they are too many, in blocks: each chunk meets each block in a
group of its own. Only query rows meet the runs; nothing else is paired.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from distillery.llm.common import stored

TREES = 24
TARGET = 0.95
#: Rows of a run, and queries that meet them, in one group (expected numbers); expected rows of the first runs.
CHUNK_ROWS = 8_192
BLOCK_QUERIES = 4_096
#: Pairs of a query and a row that are scored exactly at once.
PAIRS = 1 << 15
FIRST_ROWS = 64
SEED = 20_240_601


def usable(rows: DataFrame, vector: str) -> Column:
    """False for vectors that are null, zero, or hold a null or a number that isn't finite."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(x.isNotNull() & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def _planes(size: int, trees: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size + 1, 64 * trees))


def _strings(x: np.ndarray, extra: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """64 sign bits a tree, as unsigned numbers whose order is that of the strings."""
    side = x @ planes[:-1] + extra[:, None] * planes[-1]
    return np.packbits(side > 0, axis=1).view(">u8").astype(np.uint64)


def _hashed(nodes: DataFrame, size: int, trees: int, longest: float) -> DataFrame:
    """``node, least, vector, rows_`` (one string a tree) of every row, and ``asks`` (the same for its
    vector as a query) where it is one."""
    def hash_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = _planes(size, trees)
        for batch in batches:
            for start in range(0, batch.num_rows, 2_048):
                part = batch.slice(start, 2_048)
                x = np.array(part.column(1).values.slice(part.column(1).offsets[0].as_py(), len(part) * size).to_numpy(
                    zero_copy_only=False), np.float64).reshape(-1, size)
                norm = np.sqrt((x * x).sum(axis=1))
                extra = np.sqrt(np.maximum(longest ** 2 - norm ** 2, 0))
                rows_ = _strings(x, extra, planes).view(np.int64)
                asks = _strings(x, np.zeros(len(x)), planes).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), part.column(3),
                     *[pa.array(list(v), pa.list_(pa.int64())) for v in (rows_, asks)]],
                    ["node", "vector", "is_query", "least", "rows_", "asks"])

    return nodes.select("node", "vector", "is_query", "least").mapInArrow(
        hash_, "node long, vector array<double>, is_query boolean, least long, rows_ array<long>, asks array<long>")


def _dot(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products in double precision, in an order of summing that never varies."""
    return (rows * q).sum(axis=-1)


GROUP = ["tree", "cell", "chunk", "block"]


def _dealt(data: DataFrame, queries: DataFrame, depth: int, trees: int) -> tuple[DataFrame, DataFrame]:
    """The rows and the queries that share ``depth`` bits in a tree, by ``GROUP``: every chunk
    of a run with every block of its queries, both of bounded size."""
    cell = lambda c: F.shiftrightunsigned(c, 64 - depth) if depth else F.lit(0).cast("long")
    runs = data.select("node", "least", "vector", F.posexplode(F.slice("rows_", 1, trees)).alias("tree", "h")).withColumn(
        "cell", cell(F.col("h")))
    asked = queries.select(F.col("node").alias("query"), F.col("vector").alias("asked"),
                           F.posexplode(F.slice("asks", 1, trees)).alias("tree", "h")).withColumn("cell", cell(F.col("h")))
    sizes = data.select(F.posexplode(F.slice("rows_", 1, trees)).alias("tree", "h")).withColumn(
        "cell", cell(F.col("h"))).groupBy("tree", "cell").agg(F.ceil(F.count(F.lit(1)) / CHUNK_ROWS).alias("chunks"))
    sizes = stored(sizes.join(asked.groupBy("tree", "cell").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).alias("blocks")), ["tree", "cell"]))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    runs = runs.join(sizes, ["tree", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks"))).select(
        "tree", "cell", "chunk", each("blocks").alias("block"), "node", "least", "vector")
    asked = asked.join(sizes, ["tree", "cell"]).withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks"))).select(
        "tree", "cell", each("chunks").alias("chunk"), "block", "query", "asked")
    return runs, asked


def _scored(data: DataFrame, queries: DataFrame, depth: int, trees: int, k: int) -> DataFrame:
    """``query, node, least, score``: of each tree's run that shares ``depth`` bits with a query,
    the ``k`` rows nearest to it (from each chunk of a long run), ties to the least key."""
    runs, asked = _dealt(data, queries, depth, trees)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, ...] = ([], [], [], [])
        if left.num_rows and right.num_rows:
            x, q = (np.array(t.column(c).combine_chunks().flatten().to_numpy(), np.float64).reshape(t.num_rows, -1)
                    for t, c in ((left, "vector"), (right, "asked")))
            nodes, least, asks = (t.column(c).to_numpy() for t, c in ((left, "node"), (left, "least"), (right, "query")))
            # a matrix product may round equal scores apart: what it puts within ``off`` of the cut is scored exactly
            off = 2.0 ** -50 * x.shape[1] * np.sqrt((x * x).sum(axis=1).max())
            for start in range(0, len(q), 256):
                some = q[start:start + 256]
                all_ = some @ x.T
                n = min(k, len(x))
                cut = np.partition(all_, len(x) - n, axis=1)[:, len(x) - n]
                which, row = np.nonzero(all_ >= (cut - off * np.sqrt((some * some).sum(axis=1)))[:, None])
                exact = np.concatenate([_dot(some[which[i:i + PAIRS]], x[row[i:i + PAIRS]]) for i in range(0, len(row), PAIRS)])
                order = np.lexsort((nodes[row], least[row], -exact, which))
                which, row, exact = which[order], row[order], exact[order]
                best = np.arange(len(which)) - np.searchsorted(which, which) < n
                for column, values in zip(out, (asks[start:start + 256][which], nodes[row], least[row], exact)):
                    column.append(values[best])
        a, b, c, d = (np.concatenate(v) if v else [] for v in out)
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64()), pa.array(d, pa.float64())],
                        ["query", "node", "least", "score"])

    return runs.groupBy(*GROUP).cogroup(asked.groupBy(*GROUP)).applyInArrow(
        score, "query long, node long, least long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query, ties to the least key; the same row found in several trees
    counts once."""
    once = found.groupBy("query", "node").agg(F.min("least").alias("least"), F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "least", "node")
    return once.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).drop("r")


def nearest(rows: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding",
            trees: int = TREES, target: float = TARGET) -> DataFrame:
    """``query_id, rank, vec_id, score``: of every query row the ``k`` nearest other rows by
    inner product (all of them, if fewer), nearest first, ties to the smaller key.

    Rows whose key is null, whose vector isn't :func:`usable`, or whose vector has another
    length than most (of equally many: the greater length) take no part. Rows with the same
    key and vector are one row; a row isn't its own neighbour, nor is one with its key. An
    empty table gives an empty result.
    """
    spark = rows.sparkSession
    kind = rows.schema[key].dataType
    good = rows.filter(F.col(key).isNotNull() & usable(rows, vector)).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("is_query"))
    sizes = good.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    schema = f"query_id {kind.simpleString()}, rank int, vec_id {kind.simpleString()}, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    size = sizes[0]
    good = good.filter(F.size("vector") == size).withColumn("a", F.xxhash64("vector")).withColumn(
        "b", F.xxhash64(F.lit(7), "vector"))
    # equal vectors: one node; its k + 1 smallest keys are all that a result can need (the
    # limit by rank is applied before the shuffle)
    copies = Window.partitionBy("a", "b").orderBy("id")
    few = good.select("a", "b", "id", "vector").withColumn("r", F.dense_rank().over(copies)).filter(F.col("r") <= k + 1)
    nodes = few.groupBy("a", "b").agg(F.array_sort(F.collect_set("id")).alias("ids"), F.first("vector").alias("vector"))
    asking = good.filter("is_query").select("a", "b").distinct().withColumn("is_query", F.lit(True))
    nodes = stored(nodes.join(asking, ["a", "b"], "left").select(
        "a", "b", "ids", F.element_at("ids", 1).alias("least"), "vector", F.coalesce("is_query", F.lit(False)).alias("is_query"),
        F.monotonically_increasing_id().alias("node")))
    norm = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v)
    n, longest = nodes.agg(F.count(F.lit(1)), F.sqrt(F.max(norm))).first()
    data = stored(_hashed(nodes, size, trees, longest))
    queries = data.filter("is_query")

    depth = max(0, min(40, int(math.log2(max(1, n / FIRST_ROWS)))))
    found = stored(_best(_scored(data, queries, depth, trees, k + 1), k + 1))
    # how far up: the angle of the worst of the k nearest so far, in the lengthened space
    worst = found.groupBy("query").agg(F.min("score").alias("worst"), F.count(F.lit(1)).alias("n"))
    p = 1 - F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("worst") / (F.col("norm") * longest)))) / math.pi
    enough = 1 - (1 - target) ** (1 / trees)  # p ** depth has to reach this
    up = F.when(F.col("n") < min(k + 1, n), 0).when(p >= 1, depth).when(p <= 0, 0).otherwise(
        F.least(F.floor(F.log(F.lit(enough)) / F.log(p)), F.lit(depth)))
    needs = stored(queries.withColumn("norm", F.sqrt(norm)).join(worst.withColumnRenamed("query", "node"), "node", "left")
                   .select("node", "vector", "asks", F.coalesce(up, F.lit(0)).cast("int").alias("depth")))
    parts = [found]
    for (level,) in sorted(needs.select("depth").distinct().collect()):  # 40 depths at most
        if level < depth:
            # at the root every tree is the whole table: one is enough
            parts.append(_scored(data, needs.filter(F.col("depth") == level), level, trees if level else 1, k + 1))
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    found = stored(_best(everything, k + 1))

    # from nodes to keys: the k + 1 first of each distinct query vector, then of each query row
    named = found.join(nodes.select("node", "ids"), "node").select("query", "score", F.explode("ids").alias("id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    named = named.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)
    lists = stored(named.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("r", "id", "score"))).alias("list")).join(
        nodes.select(F.col("node").alias("query"), "a", "b"), "query").select("a", "b", "list"))
    asked = stored(good.filter("is_query").select("a", "b", "id").distinct())
    out = asked.join(lists, ["a", "b"]).select("id", F.slice(F.filter("list", lambda x: x["id"] != F.col("id")), 1, k).alias("l"))
    return out.select(F.col("id").cast(kind).alias("query_id"), F.posexplode("l").alias("i", "x")).select(
        "query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("x.id").cast(kind).alias("vec_id"),
        F.col("x.score").alias("score"))
