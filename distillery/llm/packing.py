"""Packing token sequences by cutting-stock column generation.

Documents are cut into whole sequences of the capacity and a remainder each. The histogram
of remainders by length class (256 classes at most, whatever the corpus) is a cutting-stock
problem: a linear program over patterns (how many remainders of each class share a
sequence), whose columns are priced by a knapsack dynamic program over the dual values. The
rounded-down patterns are dealt to the remainders of each class by rank. What the rounding
leaves, and a share set aside for it, is a stream of tokens that is cut freely to fill the
slack of the pattern sequences and then sequences of its own, the last of which are powers
of two: nothing is padded.

Only lengths travel through the planning; token ids are stored once and read again for the
remainders that are cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from distillery.llm.common import in_slices, map_texts, prefix_sum, stored
from distillery.llm.token_counts import worker_counter

CAPACITY = 4096
CLASSES = 256
#: Pivots after which the linear program stops where it stands (any of its bases is a valid plan).
MAX_PIVOTS = 4000
BLOCK = 1 << 16


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the pattern of largest value and its value."""
    useful = np.flatnonzero(values > 1e-12)
    pattern = np.zeros(len(values), np.int64)
    if not len(useful):
        return 0.0, pattern
    size, value = sizes[useful], values[useful]
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(size, kind="stable")
    size, value, useful = size[order], value[order], useful[order]
    for room in range(1, capacity + 1):
        k = np.searchsorted(size, room, "right")
        best[room] = best[room - 1]
        if k:
            got = best[room - size[:k]] + value[:k]
            i = int(got.argmax())
            if got[i] > best[room] + 1e-12:
                best[room], taken[room] = got[i], i
    room = capacity
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            pattern[useful[taken[room]]] += 1
            room -= size[taken[room]]
    return float(best[capacity]), pattern


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan elimination. At most 256 rows: a threaded linear algebra library, which
    shares the driver's process with the JVM gateway, isn't worth its start here."""
    n = len(matrix)
    both = np.concatenate([matrix.astype(float), np.eye(n)], axis=1)
    for i in range(n):
        pivot = i + int(np.abs(both[i:, i]).argmax())
        both[[i, pivot]] = both[[pivot, i]]
        both[i] /= both[i, i]
        factor = both[:, i].copy()
        factor[i] = 0
        both -= np.outer(factor, both[i])
    return both[:, n:]


def column_generation(demand: np.ndarray, sizes: np.ndarray, capacity: int,
                      max_pivots: int = MAX_PIVOTS) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often to use each, for the linear program that covers
    ``demand`` pieces of ``sizes`` with the fewest sequences. Revised simplex: the basis
    starts with one-class patterns; a priced column enters while its reduced cost is negative."""
    n = len(sizes)
    per = capacity // sizes
    patterns = np.diag(per).astype(np.int64)
    inverse = np.diag(1.0 / per)
    x = demand / per
    for pivot in range(max_pivots):
        duals = inverse.sum(axis=0)
        value, pattern = best_pattern(duals, sizes, capacity)
        if value <= 1 + 1e-7:
            break
        step = np.einsum("ij,j", inverse, pattern)
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        patterns[out] = pattern
        if pivot % 200 == 199:
            inverse = _inverse(patterns.T)
        else:
            row = inverse[out] / step[out]
            inverse -= np.outer(step, row)
            inverse[out] = row
        x = np.maximum(np.einsum("ij,j", inverse, demand), 0)
    return patterns, x


def plan(counts: dict[int, int], tokens: dict[int, int], unit: int, capacity: int,
         max_pivots: int = MAX_PIVOTS) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """From the histogram (pieces and their tokens by class): rows ``(class, first, last,
    sequence, each, place)``, that is ranks ``first..last-1`` of the class fill, ``each`` at a
    time, the sequences from ``sequence`` on, at ``place`` within the pattern; and the number
    of pattern sequences."""
    classes = np.array(sorted(counts), np.int64)
    if not len(classes):
        return [], 0
    demand = np.array([counts[c] for c in classes], float)
    patterns, x = column_generation(demand, classes, capacity // unit, max_pivots)
    mean = np.array([tokens[c] for c in classes]) / demand
    used = patterns @ mean  # tokens expected in a sequence of each pattern
    slack, total = float((x * (capacity - used)).sum()), float(sum(tokens.values()))
    # so many that what the others leave to the stream is 1.1 x the room within these
    kept = total / (total + 1.1 * slack)
    times = np.floor(x * kept + 1e-9).astype(np.int64)
    rank, sequence, rows = np.zeros(len(classes), np.int64), 0, []
    for pattern, n in zip(patterns, times):
        room = (demand.astype(np.int64) - rank) // np.where(pattern, pattern, 1)
        n = int(min(n, room[pattern > 0].min())) if n else 0  # rounding of the last pivot
        if n > 0:
            for place, c in enumerate(np.flatnonzero(pattern)):
                last = int(rank[c] + n * pattern[c])
                rows.append((int(classes[c]), int(rank[c]), last, sequence, int(pattern[c]), place))
                rank[c] = last
            sequence += n
    return rows, sequence


def tokenized(docs: DataFrame, tokenizer: str, capacity: int, last_id: int, key: str = "doc_id",
              text: str = "text", unit: int = CAPACITY // CLASSES, memo_pieces: int | None = None) -> DataFrame:
    """A stored row of every document: its ids' number, the CRC-32 of each whole sequence and
    of the remainder, and the remainder's ids (little-endian, 32 bits). ``memo_pieces`` bounds
    the pieces that a Python worker remembers (about 250 bytes each)."""
    path = public_tokenizers.path(tokenizer)
    end = np.array([last_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_counter(path, memo_pieces=memo_pieces)
        for part, texts in in_slices(batches):
            ids = [x + end for x in counter.ids(texts)]
            size, width = 4 * capacity, [len(x) // 4 for x in ids]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(width, pa.int64()),
                 pa.array([[zlib.crc32(x[i:i + size]) for i in range(0, len(x), size)] for x in ids],
                          pa.list_(pa.int64())),
                 pa.array([x[len(x) - len(x) % size:] for x in ids], pa.binary())],
                ["row_id", "key", "n", "crcs", "ids"])
        counter.forget()

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(key).alias("key"),
                       F.col(text).alias("text"))
    return stored(map_texts(rows, encode, f"row_id long, key {kind}, n long, crcs array<long>, ids binary").withColumn(
        "rest", F.col("n") % capacity).withColumn("class", F.ceil(F.col("rest") / unit).cast("int")).withColumn(
        "draw", F.xxhash64(F.lit("draw"), "row_id")))


def pack(rows: DataFrame, capacity: int = CAPACITY, unit: int = CAPACITY // CLASSES,
         max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """Pieces of the documents of :func:`tokenized`: ``key, start, length, ids_crc32,
    doc_tokens, sequence_id, offset``. Every token is in exactly one piece; a sequence holds at
    most ``capacity`` tokens without gaps. An empty table gives no pieces."""
    spark = rows.sparkSession
    small = rows.select("row_id", "key", "n", "rest", "class", "draw", F.size("crcs").alias("parts"))
    n_rows = rows.count()
    histogram = small.filter("rest > 0").groupBy("class").agg(  # a row a class: 256 at most
        F.count(F.lit(1)).alias("n"), F.sum("rest").alias("tokens")).collect()
    slots, n_patterns = plan({r["class"]: r["n"] for r in histogram}, {r["class"]: r.tokens for r in histogram},
                             unit, capacity, max_pivots)
    kinds = "class int, first long, last long, sequence long, each long, place long"
    by_class = spark.createDataFrame(slots, kinds).groupBy("class").agg(
        F.collect_list(F.struct("first", "last", "sequence", "each", "place")).alias("slots"))

    # ranks within each class, then each remainder's slot: the table of slots has at most
    # 256 x 256 entries, whatever the corpus
    # in order of the draw: what the patterns leave over has the largest draws of its class
    by_draw = lambda n: F.least(F.floor((F.col("draw").cast("double") / 2.0 ** 64 + 0.5) * n), F.lit(n - 1))
    ranked = prefix_sum(small.filter("rest > 0"), F.lit(1), ["draw", "row_id"], "rank", ("class",), by_draw, n_rows)
    fits = F.filter("slots", lambda s: (s["first"] <= F.col("rank")) & (F.col("rank") < s["last"]))
    dealt = stored(ranked.join(F.broadcast(by_class), "class", "left").withColumn(
        "slot", F.try_element_at(fits, F.lit(1))).drop("slots"))
    at = F.col("rank") - F.col("slot.first")
    placed = dealt.filter("slot is not null").withColumn(
        "sequence_id", F.col("slot.sequence") + F.floor(at / F.col("slot.each"))).withColumn(
        "turn", F.struct(F.col("slot.place").alias("a"), F.pmod(at, F.col("slot.each")).alias("b")))
    inside = Window.partitionBy("sequence_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    whole = placed.withColumn("offset", F.coalesce(F.sum("rest").over(inside), F.lit(0)))

    # the stream that is cut freely, and the room for it
    cut = stored(prefix_sum(dealt.filter("slot is null").select("row_id", "key", "n", "rest", "class", "draw"),
                            F.col("rest"), ["draw", "row_id"], "at", total=n_rows))
    stream = cut.agg(F.sum("rest")).first()[0] or 0
    gaps = stored(placed.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("rest")).alias("room")).filter("room > 0"))
    room = gaps.agg(F.sum("room")).first()[0] or 0
    gaps = prefix_sum(gaps, F.col("room"), ["sequence_id"], "at", total=n_patterns).select(
        "at", "room", "sequence_id", (F.lit(capacity) - F.col("room")).alias("base"))
    beyond = max(0, stream - room)
    full = beyond // capacity
    fresh = spark.range(full).select((F.col("id") * capacity + room).alias("at"), F.lit(capacity).cast("long").alias("room"),
                                     (F.col("id") + n_patterns).alias("sequence_id"), F.lit(0).cast("long").alias("base"))
    tail, left, where = [], beyond % capacity, room + full * capacity
    while left:  # powers of two: at most log2(capacity) sequences
        power = 1 << (left.bit_length() - 1)
        tail.append((where, power, n_patterns + full + len(tail), 0))
        where, left = where + power, left - power
    holes = gaps.unionByName(fresh).unionByName(
        spark.createDataFrame(tail, "at long, room long, sequence_id long, base long"))
    pieces = _overlaps(cut.select("at", "rest", "row_id", (F.col("n") - F.col("rest")).alias("from")), holes)

    # cut remainders: their ids again, only of those
    wanted = pieces.groupBy("row_id").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("cuts"))
    least = {r[0]: r[1] for r in cut.groupBy("class").agg(F.min("draw")).collect()}  # a row a class
    if least:
        bound = F.create_map(*[F.lit(x) for c in sorted(least) for x in (c, least[c])])
        some = rows.filter((F.col("rest") > 0) & (F.col("draw") >= bound[F.col("class")]))
    else:
        some = rows.filter(F.lit(False))
    cut_pieces = _cut(some.join(wanted, "row_id"), rows.schema["key"].dataType.simpleString())

    blocks = prefix_sum(rows.filter(F.col("n") >= capacity).select("row_id", "key", "n", "crcs"),
                        F.floor(F.col("n") / capacity), ["row_id"], "at", total=n_rows)
    base = n_patterns + full + len(tail)
    blocks = blocks.select("key", "n", "at", F.posexplode(F.slice("crcs", 1, F.floor(F.col("n") / capacity).cast("int")))
                           .alias("i", "crc"))
    blocks = blocks.select("key", (F.col("i") * F.lit(capacity)).cast("long").alias("start"),
                           F.lit(capacity).cast("long").alias("length"), F.col("crc").alias("ids_crc32"),
                           F.col("n").alias("doc_tokens"), (F.col("at") + F.col("i") + base).alias("sequence_id"),
                           F.lit(0).cast("long").alias("offset"))
    crc = rows.filter("rest > 0").select("row_id", F.element_at("crcs", -1).alias("ids_crc32"))
    whole = whole.join(crc, "row_id").select("key", (F.col("n") - F.col("rest")).alias("start"), F.col("rest").alias("length"),
                                             "ids_crc32", F.col("n").alias("doc_tokens"), "sequence_id", "offset")
    return whole.unionByName(cut_pieces).unionByName(blocks)


def _overlaps(cut: DataFrame, holes: DataFrame) -> DataFrame:
    """Two gapless rows of intervals on one axis: where each of ``cut`` meets each of
    ``holes``. The axis is dealt out in blocks; in each a single ordered pass carries the
    current interval of either side (linear, no pairs)."""
    def events(df: DataFrame, size: str, name: str, fields: Column) -> DataFrame:
        last = F.col("at") + F.col(size)
        span = F.explode(F.sequence(F.floor(F.col("at") / BLOCK), F.floor((last - 1) / BLOCK))).alias("block")
        return df.select("*", span).select("block", F.greatest("at", F.col("block") * BLOCK).alias("pos"),
                                           F.struct(F.col("at"), last.alias("end"), fields.alias("of")).alias(name))

    a = events(cut, "rest", "a", F.struct("row_id", "from"))
    b = events(holes, "room", "b", F.struct("sequence_id", "base"))
    both = a.unionByName(b, allowMissingColumns=True)
    order = Window.partitionBy("block").orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = both.select("block", "pos", F.last("a", True).over(so_far).alias("a"), F.last("b", True).over(so_far).alias("b"),
                       F.lead("pos").over(order).alias("next"))
    end = F.least(F.coalesce("next", (F.col("block") + 1) * BLOCK), F.col("a.end"), F.col("b.end"))
    return rows.filter("a is not null and b is not null").withColumn("length", end - F.col("pos")).filter("length > 0").select(
        F.col("a.of.row_id").alias("row_id"), (F.col("a.of.from") + F.col("pos") - F.col("a.at")).alias("start"), "length",
        F.col("b.of.sequence_id").alias("sequence_id"), (F.col("b.of.base") + F.col("pos") - F.col("b.at")).alias("offset"))


def _cut(rows: DataFrame, kind: str) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, n, rest, ids, cuts in zip(*(batch.column(i).to_pylist() for i in range(5))):
                for c in cuts:
                    a = 4 * (c["start"] - (n - rest))
                    out.append((key, c["start"], c["length"], zlib.crc32(ids[a:a + 4 * c["length"]]), n,
                                c["sequence_id"], c["offset"]))
            columns = list(zip(*out)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], batch.schema.field(0).type),
                                              *[pa.array(x, pa.int64()) for x in columns[1:]]],
                                             ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return rows.select("key", "n", "rest", "ids", "cuts").mapInArrow(
        cut, f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", last_id: int = 2, capacity: int = CAPACITY,
                   key: str = "doc_id", text: str = "text", memo_pieces: int | None = None) -> DataFrame:
    """Tokenize and pack every document (a null text is empty: the last id alone). Repeated
    rows are packed each for itself; null keys are kept; other columns aren't read."""
    unit = max(1, capacity // CLASSES)
    rows = tokenized(docs, tokenizer, capacity, last_id, key, text, unit, memo_pieces)
    return pack(rows, capacity, unit).withColumnRenamed("key", key)
