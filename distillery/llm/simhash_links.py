"""SimHash near-duplicates by a generalised pigeonhole search over bit partitions.

The fingerprint's 64 bits are grouped so that correlated bits share a partition. By the
generalised pigeonhole principle two fingerprints that differ in at most D bits are within
t_i bits on at least one partition i of m, for any thresholds t_i >= -1 that sum to
D - m + 1 (-1: the partition isn't probed). A dynamic program gives each partition its
threshold, by candidate counts estimated from all fingerprints; one side is indexed by its
partition values, the other probes all values within the threshold, candidates are verified.

A partition value shared by very many fingerprints would make a quadratic number of
candidates. The fingerprints that meet such a value are linked exactly, by another road:
two fingerprints are at most 2 bits apart if and only if they have a common neighbour at
most 1 bit from both, so each is listed under itself and its 64 neighbours; all those under
one value are linked by it, 65 at most, as a star.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distillery.llm.common import ROW_BITS, decided, in_slices, map_texts, parts_of, stored, stored_by_part
from distillery.llm.components import components

BITS = 64
#: Fingerprints under one partition value from which on the exact neighbour listing takes over.
CROWDED = 128


def simhash(text: str | None, shingle: int = 3) -> int:
    """Words are separated by ASCII white space, A-Z lower-cased. No word: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(g, 42) for g in grams], np.uint64)
    counts = np.empty((8, 8), np.int64)  # by byte of the hash and bit of the byte
    mask, starts = np.uint64(0x0101010101010101), np.arange(0, len(h), 255)
    for bit in range(8):  # eight counters of 8 bits side by side, over 255 rows at a time
        packed = np.add.reduceat((h >> np.uint64(bit)) & mask, starts)
        counts[:, bit] = packed.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    bits = counts.reshape(-1) * 2 > len(h)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", shingle: int = 3) -> DataFrame:
    """A row of every document, stored by part: ``row_id``, ``fp`` (the fingerprint's bits as a
    long), ``digest`` (of the text) and columns ``keep`` as c0, c1, ... A text that is kept is sent
    to the Python workers once."""
    schema = ", ".join(["digest long"] + [
        f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)] + ["fp long"])
    at = f"c{keep.index(text)}" if text in keep else "x_text"
    n = 1 + len(keep)

    def hash_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in in_slices(batches, at):
            fp = np.array([simhash(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.array(fp)], [*part.schema.names[:n], "fp"])

    rows = docs.select(F.xxhash64(text).alias("digest"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)],
                       *([] if text in keep else [F.col(text).alias("x_text")]))
    rows = stored_by_part(map_texts(rows, hash_, schema), parts_of(docs))
    return rows.withColumn("row_id", F.shiftleft(F.col("x_part").cast("long"), 33) + F.col("x_at"))


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and how many have each pair of bits set (64 x 64):
    summed by task, then by Spark; 4,096 numbers come to the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            for start in range(0, len(fps), 65_536):
                x = np.unpackbits(fps[start:start + 65_536].view(np.uint8).reshape(-1, 8), axis=1,
                                  bitorder="little").astype(np.float32)
                total += x.T @ x
                n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(BITS * BITS + 1)), pa.array(
                np.append(total.reshape(-1), n).astype(np.int64))], ["slot", "n"])

    got = nodes.select("fp").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n")).collect()
    out = np.zeros(BITS * BITS + 1)
    for slot, n in got:
        out[slot] = n
    return int(out[-1]), out[:-1].reshape(BITS, BITS)


def partition_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Groups of (nearly) equal size: each grows from the strongest correlated bits left."""
    p = np.diag(together) / max(n, 1)
    deviation = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    likeness = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(deviation, deviation))
    np.fill_diagonal(likeness, 0)
    left, out = list(range(BITS)), []
    for i in range(parts, 0, -1):
        size = -(-len(left) // i)
        group = [max(left, key=lambda b: likeness[b, left].max())]
        left.remove(group[0])
        while len(group) < size:
            best = max(left, key=lambda b: likeness[b, group].sum())
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def allocate(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds (at least -1) that sum to ``total`` at the least cost; ``costs[i][t + 1]`` is
    that of threshold t in partition i. Dynamic program over partitions and sums."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for done, (cost, chosen) in best.items():
            for t, more in enumerate(row, -1):
                if done + t not in after or cost + more < after[done + t][0]:
                    after[done + t] = (cost + more, [*chosen, t])
        best = after
    return best[total][1]


def _value(fp: Column, bits: list[int]) -> Column:
    mask = sum(1 << b for b in bits)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def _flips(bits: list[int], most: int) -> list[int]:
    out = [sum(1 << b for b in some) for size in range(max(0, most) + 1) for some in combinations(bits, size)]
    return [x - (1 << 64) if x >> 63 else x for x in out]


def _probes(fp: Column, part: int, bits: list[int], threshold: int) -> Column:
    flips = F.array(*[F.lit(x) for x in _flips(bits, threshold)])
    return F.transform(flips, lambda x: F.struct(
        F.lit(part).alias("part"), _value(fp, bits).bitwiseXOR(x).alias("value")))


def search_plan(nodes: DataFrame, distance: int, choices: tuple[int, ...] = (2, 3, 4)) -> list[tuple[list[int], int]]:
    """Partitions and thresholds of the least estimated cost: probes and candidates. Equal
    values are counted over all fingerprints; pairs some bits apart follow from them by each
    bit's balance."""
    n, together = bit_statistics(nodes)
    p = np.diag(together) / max(n, 1)
    differ = 2 * p * (1 - p)
    odds = differ / np.maximum(1 - differ, 0.5)
    best, chosen = float("inf"), []
    groups = {m: partition_bits(n, together, m) for m in choices if m <= distance + 2}
    values = [(m, i, bits) for m, g in groups.items() for i, bits in enumerate(g)]
    keys = F.array(*[F.struct(F.lit(m * 100 + i).alias("part"), _value(F.col("fp"), bits).alias("value"))
                     for m, i, bits in values])
    sizes = nodes.select(F.inline(keys)).groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
    # a crowded value is handled by neighbour listing, at 65 rows a fingerprint
    equal = {r[0]: float(r[1]) for r in sizes.groupBy("part").agg(F.sum(F.col("n") * F.least(
        F.col("n"), F.lit(CROWDED)) / 2.0)).collect()}
    for m, group in groups.items():
        costs = []
        for i, bits in enumerate(group):
            same, r = equal.get(m * 100 + i, 0.0), odds[bits]
            pairs = [0.0, same, same * (1 + r.sum()), same * (1 + r.sum() + (r.sum() ** 2 - (r ** 2).sum()) / 2)]
            probes = [0.0] + [n * sum(comb(len(bits), s) for s in range(t + 1)) for t in range(distance + 1)]
            costs.append([a + b for a, b in zip(pairs, probes)])
        thresholds = allocate(costs, distance - m + 1)
        cost = sum(c[t + 1] for c, t in zip(costs, thresholds))
        if cost < best:
            best, chosen = cost, [(bits, t) for bits, t in zip(group, thresholds) if t >= 0]
    return chosen


def links(nodes: DataFrame, distance: int = 2, crowded: int = CROWDED) -> DataFrame:
    """``u, v``: enough pairs of distinct fingerprints (column ``fp``) at most ``distance`` (0 to
    2) bits apart to connect all that are connected; each pair given is such a pair."""
    if not 0 <= distance <= 2:
        raise ValueError("distance must be 0, 1 or 2")
    plan = search_plan(nodes, distance)
    fp = F.col("fp")
    index = nodes.select("fp", F.inline(F.array(*[F.struct(
        F.lit(i).alias("part"), _value(fp, bits).alias("value")) for i, (bits, _) in enumerate(plan)])))
    counts = stored(index.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")))
    probe = nodes.select("fp", F.inline(F.concat(*[_probes(fp, i, bits, t) for i, (bits, t) in enumerate(plan)])))
    some = counts.filter(F.col("n") <= crowded)
    if all(t == 0 for _, t in plan):  # a value alone has no candidates
        some = some.filter("n > 1")
    near = (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance) & (F.col("u") != F.col("v"))
    candidates = index.join(some.select("part", "value"), ["part", "value"]).withColumnRenamed("fp", "v").join(
        probe.withColumnRenamed("fp", "u"), ["part", "value"])
    found = candidates.filter(near).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # those that meet a crowded value: listed under themselves and their neighbours
    many = stored(counts.filter(F.col("n") > crowded).select("part", "value"))
    meet = probe.join(many, ["part", "value"]).select("fp").distinct()
    around = F.array(*[F.lit(x) for x in _flips(list(range(BITS)), 1 if distance == 2 else 0)])
    if distance == 1:  # a common neighbour at distance 1 from one side alone
        even = F.bit_count("fp") % 2 == 0
        around = F.when(even, F.array(*[F.lit(x) for x in _flips(list(range(BITS)), 1)])).otherwise(around)
    listed = meet.select("fp", F.explode(F.transform(around, lambda x: fp.bitwiseXOR(x))).alias("c"))
    if distance == 1:
        odd = listed.filter(F.bit_count("fp") % 2 == 1)
        stars = listed.filter((F.bit_count("fp") % 2 == 0) & (F.col("c") != F.col("fp"))).join(
            odd.withColumnRenamed("fp", "v"), "c").select(F.col("fp").alias("u"), "v")
    else:
        # 65 fingerprints at most have a neighbour (or itself) in common
        stars = listed.groupBy("c").agg(F.min("fp").alias("v"), F.collect_list("fp").alias("all")).filter(
            F.size("all") > 1).select(F.explode("all").alias("u"), "v").filter("u <> v")
    return found.union(stars)


def groups(rows: DataFrame, distance: int = 2, crowded: int = CROWDED) -> DataFrame:
    """The stored rows of :func:`fingerprints` with ``root``: the least fingerprint of those
    reachable over links. Exact copies share a fingerprint and so need no link."""
    nodes = stored(rows.select("fp").distinct())
    roots = components(links(nodes, distance, crowded))
    named = stored(nodes.join(roots.withColumnRenamed("v", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root")))
    return rows.join(named, "fp")  # both stored: split by adaptive execution at a hot fingerprint


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                    distance: int = 2) -> DataFrame:
    """``key, fingerprint, component_id`` of every row, ``component_id`` being the smallest key
    reachable over fingerprints that differ in at most ``distance`` bits, its own included
    (null if all of them are null).

    Null, empty and blank texts have fingerprint zero, which links like any other; repeated
    rows are in one component. An empty table gives an empty result.
    """
    rows = stored(groups(fingerprints(docs, [key], text, shingle), distance).select("c0", "fp", "root"))
    first = stored(rows.groupBy("root").agg(F.min("c0").alias("component_id")))
    return rows.join(first, "root").select(
        F.col("c0").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                         distance: int = 2) -> DataFrame:
    """The columns of ``docs``; of each component one row stays, that of the least key (nulls
    last), then text digest, then place in the input."""
    columns = docs.columns
    rows = fingerprints(docs, columns, text, shingle)
    at = columns.index(key)
    small = groups(rows.select("row_id", "digest", F.col(f"c{at}").alias("key"), "fp"), distance)
    first = small.groupBy("root").agg(F.min(F.struct(F.col("key").isNull().alias("n"), "key", "digest", "row_id")).alias("first"))
    keep = first.select("first.row_id").withColumn("stays", F.lit(True))
    # only ids and decisions are shuffled; the texts stay in the files that they were written to
    verdicts = stored(small.select("row_id").join(keep, "row_id", "left").select(
        F.shiftright("row_id", 33).cast("int").alias("x_part"), F.col("row_id").bitwiseAND(F.lit(ROW_BITS)).alias("x_at"),
        F.coalesce("stays", F.lit(False)).alias("stays")))
    return decided(rows, verdicts, "x_verdict", parts_of(docs)).filter("x_verdict.stays").select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
