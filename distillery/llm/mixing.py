"""Mixing sources to target weights by a low-discrepancy schedule. DataFrame operations only.

Every source's documents are shuffled (by digest) and their words laid end to end; the
stream is cut into blocks of equal size, a size of the source's own: that of the mix, or, in a
small source, so much less that it has about ``LEAST_BLOCKS`` of them, down to a word each.
A source's target is a number of blocks, its quota. Slot i of the schedule has the
golden-ratio point frac(i * phi), which the cumulative quotas map to a source; the slots of a
source are ranked, and the slot of rank r takes block r modulo the number of blocks, so that a
source is repeated only after all of it was taken. Golden-ratio points are evenly spread in
every prefix of the schedule: each source's share holds all along, to a few blocks. A source
ends with its quota: what it gets beyond it is left out, and what it lacks by then (a few
slots) follows at the schedule's end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from distillery.llm.common import ROW_BITS, decided, parts_of, prefix_sum, stored, stored_by_part

WORD = r"[^\x20\x09-\x0D]+"
#: Points are multiples of 2**-31; the step is the odd number next to 2**31 divided by the golden ratio.
GRID, STEP = 1 << 31, 1327217885
CELLS = 4096
CHUNK = 1 << 14
#: Blocks that a source has at least, if it has so many words.
LEAST_BLOCKS = 1024


def targets(rows: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """A row a source: its size, ordinal (by code point, null last) and target. Sources weigh
    ``weights`` in turn and share ``share`` x all sizes; no target is above ``most`` x its
    source's size, what is over being shared again by weight (a source is at its bound if
    the level at which it gets there costs no more than there is)."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    level = Window.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = sizes.withColumn("sid", F.row_number().over(order) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int")))
    s = s.withColumn("bound", F.col("source_size") * most).withColumn("ratio", F.col("bound") / F.col("weight"))
    s = s.withColumn("bounds_below", F.coalesce(F.sum("bound").over(level), F.lit(0))).withColumn(
        "weights_below", F.coalesce(F.sum("weight").over(level), F.lit(0))).withColumn(
        "all_weights", F.sum("weight").over(everything)).withColumn(
        "budget", F.sum("source_size").over(everything) * F.lit(share))
    s = s.withColumn("full", F.col("bounds_below") + F.col("ratio") * (F.col("all_weights") - F.col("weights_below"))
                     <= F.col("budget"))
    s = s.withColumn("rest", F.col("budget") - F.sum(F.when(F.col("full"), F.col("bound")).otherwise(0)).over(everything))
    s = s.withColumn("open", F.col("all_weights") - F.sum(F.when(F.col("full"), F.col("weight")).otherwise(0)).over(everything))
    return s.select("source", "source_size", F.col("sid").cast("long").alias("sid"), F.when(
        F.col("full"), F.col("bound").cast("double")).otherwise(F.col("weight") * F.col("rest") / F.col("open")).alias("target"))


def with_quotas(sources: DataFrame, block: int, most: int) -> DataFrame:
    """``sources`` with ``own`` (words of a block), ``blocks`` and ``quota`` (blocks to take): as many
    whole rounds as the target holds, and of the last round so many blocks as come nearest."""
    size, target = F.col("source_size"), F.col("target")
    s = sources.withColumn("own", F.greatest(F.lit(1).cast("long"), F.least(
        F.lit(block).cast("long"), F.floor(size / LEAST_BLOCKS)))).withColumn("blocks", F.ceil(size / F.col("own")))
    rounds = F.least(F.floor(F.try_divide(target, size)), F.lit(most).cast("long"))
    last = F.least(F.col("blocks"), F.floor((target - rounds * size) / F.col("own") + 0.5))
    return s.withColumn("quota", F.when((size > 0) & (target > 0), F.least(
        rounds * F.col("blocks") + last, most * F.col("blocks"))).otherwise(F.lit(0)).cast("long"))


def schedule(spark, sources: DataFrame, slots: int, n_sources: int) -> DataFrame:
    """``slot, sid, rank, block``: the sources' blocks in the order of the mix, from the rows of
    :func:`with_quotas`; ``slots`` is the sum of quotas."""
    all_ = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    s = sources.filter("quota > 0").withColumn("upto", F.sum("quota").over(all_))
    edge = lambda c: F.floor(c.cast("double") / F.lit(float(max(slots, 1))) * F.lit(float(GRID)))
    s = s.select("sid", "blocks", "quota", edge(F.col("upto") - F.col("quota")).alias("lo"), edge(F.col("upto")).alias("hi"))
    width = GRID // CELLS
    cells = s.filter("hi > lo").withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))))
    points = spark.range(slots).select(F.col("id").alias("slot"), (F.col("id") % GRID * STEP % GRID).alias("point"))
    hit = points.withColumn("cell", F.floor(F.col("point") / width)).join(cells, "cell").filter("lo <= point and point < hi")
    hit = hit.withColumn("chunk", F.floor(F.col("slot") / CHUNK)).select("slot", "sid", "blocks", "quota", "chunk")
    counts = stored(hit.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n")))
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.select("sid", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("sid", "chunk").orderBy("slot")
    ranked = hit.join(earlier, ["sid", "chunk"]).withColumn("rank", F.col("before") + F.row_number().over(inside) - 1)
    ranked = ranked.filter(F.col("rank") < F.col("quota")).select("slot", "sid", "rank", "blocks")
    got = counts.groupBy(F.col("sid").alias("g")).agg(F.sum("n").alias("got"))
    lacking = s.join(got, F.col("sid") == F.col("g"), "left").withColumn("got", F.coalesce("got", F.lit(0))).filter("got < quota")
    rest = lacking.withColumn("rank", F.explode(F.sequence(F.col("got"), F.col("quota") - 1)))
    rest = rest.select((F.lit(slots) + (F.col("rank") - F.col("got")) * n_sources + F.col("sid")).alias("slot"), "sid", "rank", "blocks")
    return ranked.unionByName(rest).select("slot", "sid", "rank", (F.col("rank") % F.col("blocks")).alias("block"))


def block_words(total: float, sources: int) -> int:
    """Words in a block: it grows with the square root of the mix, so that both the number of
    slots and each source's relative error stay small at every size."""
    return max(1, int((total / max(1, sources)) ** 0.5 / 8))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2,
        keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: the key) and ``size, source_size, target, taken, first_slot`` of every row.

    ``taken`` counts the words that the scheduled blocks take of a document, repeats counted:
    at most ``most`` x its size; ``first_slot`` is the first slot that takes some of it (null if none
    does). A source gets its target to half a block, one of few words to a word. A null text
    has size 0; null sources are one source, the last. Of repeated rows each is a document
    (which of them is taken when doesn't matter). An empty table gives an empty mix. Reruns agree,
    whatever the partitioning.
    """
    spark = docs.sparkSession
    keep = keep or [key]
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("-")), F.coalesce(F.col(text), F.lit(""))))
    # a row's place is written down here and read ever after; what is kept stays there
    base = stored_by_part(docs.select(
        F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        digest.alias("draw"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)]), parts_of(docs))
    row_id = F.shiftleft(F.col("x_part").cast("long"), 33) + F.col("x_at")
    rows = base.select(row_id.alias("row_id"), "source", "size", "draw")
    sources = stored(targets(rows, weights, share, most))
    n_sources, mixed = sources.agg(F.count(F.lit(1)), F.sum("target")).first()
    sources = stored(with_quotas(sources, block_words(mixed or 0, n_sources), most))
    by_source = sources.select(F.col("source").alias("name"), "sid", "source_size", "target", "own")
    rows = stored(rows.join(by_source, F.col("source").eqNullSafe(F.col("name"))).drop("source", "name"))
    slots = sources.agg(F.sum("quota")).first()[0] or 0
    taken = schedule(spark, sources, slots, n_sources).groupBy("sid", "block").agg(
        F.count(F.lit(1)).alias("times"), F.min("slot").alias("first"))
    hexes = F.conv(F.substring("draw", 1, 8), 16, 10).cast("long")
    placed = prefix_sum(rows.filter("size > 0").select("row_id", "sid", "size", "draw", "own"), F.col("size"),
                        ["draw", "row_id"], "at", ("sid",), lambda n: F.floor(hexes * n / F.lit(float(1 << 32))))
    own = F.col("own")
    pieces = placed.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("at") / own), F.floor((F.col("at") + F.col("size") - 1) / own))))
    words = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * own) - F.greatest("at", F.col("block") * own)
    parts = pieces.select("row_id", "sid", "block", words.alias("words")).join(taken, ["sid", "block"]).groupBy("row_id").agg(
        F.sum(F.col("words") * F.col("times")).alias("taken"), F.min("first").alias("first_slot"))
    done = stored(rows.join(parts, "row_id", "left").select(
        F.shiftright("row_id", 33).cast("int").alias("x_part"), F.col("row_id").bitwiseAND(F.lit(ROW_BITS)).alias("x_at"),
        "source_size", "target", "taken", "first_slot"))
    return decided(base, done, "x_mix", parts_of(docs)).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "size", "x_mix.source_size", "x_mix.target",
        F.coalesce("x_mix.taken", F.lit(0)).alias("taken"), "x_mix.first_slot")


#: The same in DuckDB SQL, over the table ``documents``.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(text, '')) AS draw FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS sid FROM s0),
s2 AS (SELECT *, CASE sid % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 2 AS bound FROM s1),
s3 AS (SELECT *, bound::DOUBLE / weight AS ratio FROM s2),
s4 AS (SELECT *, coalesce(sum(bound) OVER w, 0)::BIGINT AS bounds_below, coalesce(sum(weight) OVER w, 0)::BIGINT AS weights_below,
              (sum(weight) OVER ())::BIGINT AS all_weights, (sum(source_size) OVER ())::BIGINT * 1.5::DOUBLE AS budget
       FROM s3 WINDOW w AS (ORDER BY ratio, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s5 AS (SELECT *, bounds_below + ratio * (all_weights - weights_below) <= budget AS filled FROM s4),
s6 AS (SELECT *, budget - (sum(CASE WHEN filled THEN bound ELSE 0 END) OVER ())::BIGINT AS rest,
              all_weights - (sum(CASE WHEN filled THEN weight ELSE 0 END) OVER ())::BIGINT AS opened FROM s5),
s AS (SELECT source, source_size, sid, CASE WHEN filled THEN bound::DOUBLE ELSE weight * rest / opened END AS target FROM s6),
b AS (SELECT greatest(1, floor(sqrt(sum(target) / count(*)) / 8)::BIGINT) AS block, sum(target) AS mixed FROM s),
q0 AS (SELECT s.*, greatest(1, least(block, floor(source_size::DOUBLE / 1024)::BIGINT)) AS own FROM s, b),
q1 AS (SELECT *, ceil(source_size::DOUBLE / own)::BIGINT AS blocks,
              CASE WHEN source_size > 0 THEN least(floor(target / source_size)::BIGINT, 2) END AS rounds FROM q0),
q AS (SELECT *, CASE WHEN source_size > 0 AND target > 0 THEN least(rounds * blocks + least(blocks,
              floor((target - rounds * source_size) / own + 0.5::DOUBLE)::BIGINT), 2 * blocks) ELSE 0 END AS quota FROM q1),
n AS (SELECT coalesce(sum(quota), 0)::BIGINT AS slots, count(*) AS n_sources FROM q),
p AS (SELECT sid, blocks, quota, floor((upto - quota)::DOUBLE / slots * 2147483648.0::DOUBLE)::BIGINT AS lo,
             floor(upto::DOUBLE / slots * 2147483648.0::DOUBLE)::BIGINT AS hi
      FROM (SELECT *, (sum(quota) OVER (ORDER BY sid))::BIGINT AS upto FROM q WHERE quota > 0), n),
points AS (SELECT range AS slot, range % 2147483648 * 1327217885 % 2147483648 AS point FROM range((SELECT slots FROM n))),
hits AS (SELECT sid, blocks, quota, slot, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS rank
         FROM points JOIN p ON lo <= point AND point < hi),
lacking AS (SELECT p.sid, blocks, quota, coalesce(got, 0) AS got FROM p LEFT JOIN (SELECT sid, count(*) AS got FROM hits GROUP BY sid) USING (sid)
            WHERE coalesce(got, 0) < quota),
rest AS (SELECT sid, blocks, got, unnest(range(got, quota)) AS rank FROM lacking),
ranked AS (SELECT sid, rank % blocks AS block, slot FROM hits WHERE rank < quota
           UNION ALL SELECT sid, rank % blocks, slots + (rank - got) * n_sources + sid FROM rest, n),
taken AS (SELECT sid, block, count(*) AS times, min(slot) AS first FROM ranked GROUP BY ALL),
placed AS (SELECT d.*, sid, source_size, target, own, row_number() OVER () AS row_id,
                  (coalesce(sum(size) OVER (PARTITION BY sid ORDER BY draw ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS pos
           FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
pieces AS (SELECT row_id, sid, pos, size, own, unnest(range(pos // own, (pos + size - 1) // own + 1)) AS block FROM placed WHERE size > 0),
parts AS (SELECT row_id, sum((least(pos + size, (block + 1) * own) - greatest(pos, block * own)) * times) AS taken, min(first) AS first_slot
          FROM pieces JOIN taken USING (sid, block) GROUP BY row_id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, first_slot FROM placed LEFT JOIN parts USING (row_id)
"""
