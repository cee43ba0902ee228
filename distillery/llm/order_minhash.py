"""Order MinHash fingerprints of whole texts.

Elements are the character k-mers of a text numbered by occurrence. For each of the
signature's hash functions the elements with the least hash values are selected, put back
into text order, and their k-mers hashed as one tuple: a place agrees if two texts share
the selected k-mers *and* their order, so that likeness follows edit distance, not only
shared content.

The hash values of one element under all functions are a Poisson process: its arrivals in
ascending order, each marked with a function. Only arrivals below a threshold that scales
as 1 / (number of elements) are generated, so a text costs time in proportion to its
length, not to length x functions; texts for which a function got too few arrivals are
done again with a doubled threshold, which gives the very same values.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 7
PLACES = 64
TUPLE = 2
#: Arrivals expected for each function at first.
ARRIVALS = 10.0
BATCH_CHARS = 60_000
BATCH_TEXTS = 4096

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # powers of _ODD and of its inverse


def _powers(n: int) -> list[np.ndarray]:
    while len(_tables[0]) < n:  # doubling: base**(i + half) = base**i * base**half
        half = len(_tables[0])
        for i, base in enumerate((_ODD, _INVERSE)):
            _tables[i] = np.concatenate([_tables[i], _tables[i] * np.uint64(pow(base, half, 1 << 64))])
    return [x[:n] for x in _tables]


def _elements(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts together, at each character: the hash of the k-mer that begins there and
    of the element (k-mer and occurrence). Where each text begins, and its number of elements.
    A text of 1 to k-1 characters is one element; what begins in a text's last k-1 characters
    isn't one."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    n = int(sizes.sum())
    begin = np.cumsum(sizes) - sizes
    count = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    codes = np.zeros(n + k, np.uint64)
    codes[:n] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    power, inverse = _powers(n + k)
    sums = np.cumsum(codes * power)
    kmer = sums[k - 1:n + k - 1].copy()
    kmer[1:] -= sums[:max(0, n - 1)]
    kmer = _mix(kmer * inverse[:n])
    for i in np.flatnonzero((sizes > 0) & (sizes < k)):
        a, b = begin[i], begin[i] + sizes[i]
        part = sums[b - 1:b] - (sums[a - 1:a] if a else np.uint64(0))
        kmer[a:a + 1] = _mix(part * inverse[a:a + 1] + np.uint64(sizes[i]))
    # occurrences: order by (text, k-mer), then by place; the low bits of the key hold the place
    low = np.uint64((1 << max(1, int(n - 1).bit_length())) - 1)
    salt = _mix(np.arange(1, len(texts) + 1, dtype=np.uint64))
    place = np.arange(n, dtype=np.uint64)
    key = ((kmer + np.repeat(salt, sizes)) & ~low) | place
    key.sort()
    here = (key & low).astype(np.int64)
    key &= ~low
    place[1:][key[1:] != key[:-1]] = 0  # place becomes: how many before in the run
    run = place.astype(np.int64)
    run[:1] = 0
    again = np.flatnonzero(run)
    start = np.flatnonzero(run == 0)
    run[again] = again - start[np.searchsorted(start, again, "right") - 1]
    occurrence = np.empty(n, np.uint64)
    occurrence[here] = run
    occurrence += np.uint64(1)
    occurrence *= np.uint64(0xD6E8FEB86659FD93)
    return kmer, _mix(occurrence + kmer), begin, count


def _signatures(texts: list[str], k: int, places: int, size: int) -> np.ndarray:
    """A row of ``places`` 16-bit numbers for each text; zeros for an empty one."""
    kmer, element, begin, count = _elements(texts, k)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros((len(texts), places), np.uint16)
    # texts of no more than `size` elements select them all
    for i in np.flatnonzero((count > 0) & (count <= size)):
        out[i] = _tuple_hash(kmer[begin[i]:begin[i] + count[i]][None, :], np.array([count[i]]))[0]
    todo, rate = np.flatnonzero(count > size), ARRIVALS
    while len(todo):
        limit = np.zeros(len(texts))
        limit[todo] = rate / count[todo]
        # the first arrival is below the limit if the element's hash is below this
        bound = (-np.expm1(-limit * places) * 2.0 ** 53).astype(np.uint64)
        if rate == ARRIVALS:
            bounds = np.repeat(bound, sizes)
            tails = np.concatenate([np.arange(begin[i] + count[i], begin[i] + sizes[i]) for i in todo])
            bounds[tails] = 0
            e = np.flatnonzero((element >> np.uint64(11)) < bounds)
        else:
            e = np.concatenate([begin[i] + np.flatnonzero(
                (element[begin[i]:begin[i] + count[i]] >> np.uint64(11)) < bound[i]) for i in todo])
        owner = np.searchsorted(begin, e, "right") - 1
        state, when = element[e], np.zeros(len(e))
        got = []
        while len(e):
            when = when - np.log1p(-((state >> np.uint64(11)).astype(np.float64) * 2.0 ** -53)) / places
            keep = when < limit[owner]
            e, owner, state, when = e[keep], owner[keep], state[keep], when[keep]
            slot = owner * places + (_mix(state ^ np.uint64(_ODD)) % np.uint64(places)).astype(np.int64)
            got.append((e, slot, when * 2.0 ** np.ceil(np.log2(count[owner]))))
            state = _mix(state + np.uint64(_ODD))
        e, slot, when = map(np.concatenate, zip(*got))
        # by slot, then time: fixed point, in a unit that depends on the text alone
        order = np.argsort((slot.astype(np.uint64) << np.uint64(42)) | (when * 2.0 ** 32).astype(np.uint64))
        e, slot, selected = _select(e[order], slot[order], size)
        pick, of = e[selected], slot[selected]
        have = np.bincount(of, minlength=len(texts) * places).reshape(len(texts), places)
        done = todo[(have[todo] == size).all(axis=1)]
        if len(done):
            ready = np.zeros(len(texts), bool)
            ready[done] = True
            ready = ready[of // places]
            pick, of = pick[ready].reshape(-1, size), of[ready][::size]
            out[of // places, of % places] = _tuple_hash(kmer[np.sort(pick, axis=1)], np.full(len(of), size))
        todo = np.setdiff1d(todo, done, assume_unique=True)
        rate *= 2
    return out


def _select(e: np.ndarray, slot: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Drops an element's later arrivals at a slot among its first ``2 * size`` rows and marks
    the first ``size`` rows of each slot that remain (rows come in order of slot and time)."""
    again = np.zeros(len(e), bool)
    for back in range(1, 2 * size):
        again[back:] |= (e[back:] == e[:-back]) & (slot[back:] == slot[:-back])
    e, slot = e[~again], slot[~again]
    rank = np.zeros(len(slot), np.int64)
    for back in range(1, size + 1):
        rank[back:] += slot[back:] == slot[:-back]
    return e, slot, rank < size


def _tuple_hash(kmers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    h = sizes.astype(np.uint64)
    for i in range(kmers.shape[1]):
        h = _mix(h * np.uint64(_ODD) + kmers[:, i])
    return np.maximum(h >> np.uint64(48), np.uint64(1)).astype(np.uint16)


def signatures(texts: list[str], k: int = K, places: int = PLACES, size: int = TUPLE) -> np.ndarray:
    out, start, total = [np.zeros((0, places), np.uint16)], 0, 0
    for i, t in enumerate(texts):
        if i > start and (total + len(t) > BATCH_CHARS or i - start == BATCH_TEXTS):
            out.append(_signatures(texts[start:i], k, places, size))
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        out.append(_signatures(texts[start:], k, places, size))
    return np.concatenate(out)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def _hex(rows: np.ndarray) -> list[str]:
    return [x.astype(">u2").tobytes().hex() for x in rows]


def _bucketed(docs: DataFrame, key: str, text: str, buckets: int) -> DataFrame:
    """Rows with ``bucket`` (ranges of the key, ascending) and ``copy``: each bucket also gets
    a copy of the row that follows its last one, so that every row's successor is beside it.
    Bucket bounds and first keys: one number a bucket goes to the driver."""
    from pyspark.ml.feature import Bucketizer

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = rows.withColumn("x", F.coalesce(F.col("key").cast("double"), F.lit(float("-inf"))))
    points = sorted(set((keyed.filter("key is not null").agg(F.percentile_approx(
        "x", [i / buckets for i in range(1, buckets)], 20 * buckets)).first()[0] or []) if buckets > 1 else []))
    splits = [float("-inf"), *points, float("inf")]
    if points:
        keyed = Bucketizer(splits=splits, inputCol="x", outputCol="bucket").transform(keyed).withColumn(
            "bucket", F.col("bucket").cast("int"))
    else:
        keyed = keyed.withColumn("bucket", F.lit(0))
    first = {r[0]: r[1] for r in keyed.groupBy("bucket").agg(F.min(F.struct(F.col("key"))).alias("k")).select(
        "bucket", "k.key").collect()}
    there = sorted(first)
    before = {b: there[i - 1] for i, b in enumerate(there)}  # the first comes after the last
    if not there:
        return keyed.select("key", "text", "bucket", F.lit(0).alias("copy"))
    head = F.create_map(*[x for b in there for x in (F.lit(b), F.lit(first[b]).cast(docs.schema[key].dataType))])
    prior = F.create_map(*[F.lit(x) for b in there for x in (b, before[b])])
    is_head = F.col("key").eqNullSafe(head[F.col("bucket")])
    own = F.struct(F.col("bucket"), F.lit(0).alias("copy"))
    moved = F.struct(prior[F.col("bucket")].alias("bucket"), F.lit(1).alias("copy"))
    return keyed.withColumn("to", F.explode(F.when(is_head, F.array(own, moved)).otherwise(F.array(own)))).select(
        "key", "text", "to.bucket", "to.copy")


def order_minhash(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, places: int = PLACES,
                  size: int = TUPLE, buckets: int | None = None) -> DataFrame:
    """``key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``
    of every row. The edited text has its last quarter replaced by the beginning of the next
    document by ascending key (then text), the first following the last.

    Null texts are empty; an empty text's fingerprint is all zeros, and likeness of two empty
    texts is 1. Null keys come first; rows with equal keys are ordered by text; repeated rows
    follow one another. A single document follows itself. Other columns aren't read.
    """
    spark = docs.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[key].dataType.simpleString()
    rows = _bucketed(docs, key, text, n).repartitionById(n, F.col("bucket")).sortWithinPartitions(
        "bucket", "copy", "key", "text")
    schema = (f"key {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                waiting += zip(*(part.column(i).to_pylist() for i in range(4)))
                if sum(len(x[1]) for x in waiting) >= BATCH_CHARS and len(waiting) > 1:
                    yield done(waiting, batch.schema.field(0).type)
                    waiting = waiting[-1:]
        if len(waiting) > 1:
            yield done(waiting, batch.schema.field(0).type)

    def done(rows_: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
        """All rows but the last, which is there as a successor."""
        texts = [x[1] for x in rows_]
        edited = []
        for a, b in zip(texts, texts[1:]):
            quarter = len(a) // 4
            edited.append(a[:len(a) - quarter] + b[:quarter])
        own, other = signatures(texts, k, places, size), signatures(edited, k, places, size)
        live = [i for i, x in enumerate(rows_[:-1]) if not x[3]]
        hexes, more = _hex(own), _hex(other)
        near, after = likeness(own[:-1], other), likeness(own[:-1], own[1:])
        return pa.RecordBatch.from_arrays([
            pa.array([rows_[i][0] for i in live], key_type), pa.array([len(texts[i]) for i in live], pa.int64()),
            pa.array([hashlib.sha256(edited[i].encode("utf-8", "surrogatepass")).hexdigest() for i in live], pa.string()),
            pa.array([hexes[i] for i in live], pa.string()), pa.array([more[i] for i in live], pa.string()),
            pa.array(near[live], pa.float64()), pa.array(after[live], pa.float64())],
            ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return rows.mapInArrow(fingerprint, schema).withColumnRenamed("key", key)
