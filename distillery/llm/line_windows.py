"""Line deduplication by overlapping three-line windows.

Every run of three consecutive lines of a document is a window, known by a 128-bit digest.
The first occurrence of a window (by document key, then text digest, then line) is kept; at
later ones the lines it covers are removed, covered positions being merged, whatever the
window repeats across documents or within one. Only digests and positions are shuffled to
find them; whole texts move once, to be rebuilt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distillery.llm.common import stored

LINES = 3


def covered_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", lines: int = LINES) -> DataFrame:
    """``key, x_text, covered``: for each document (key and 64-bit text digest) with repeats,
    the sorted numbers (from 0) of the lines to remove. Bounded by a document's lines."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    parts = F.transform(F.split("text", "\n", -1), lambda x: F.trim(x))
    n = F.size("line")
    spots = F.when(n >= lines, F.sequence(F.lit(0), n - lines)).otherwise(F.array().cast("array<int>"))

    def window(i):
        run = F.slice(F.col("line"), i + 1, lines)
        return F.struct(i.alias("at"), F.xxhash64(F.lit(1), run).alias("h1"), F.xxhash64(F.lit("w"), run).alias("h2"),
                        (F.array_max(F.transform(run, F.length)) > 0).alias("has_text"))

    found = rows.filter("text is not null").withColumn("line", parts).select(
        "key", F.xxhash64("text").alias("digest"), F.inline(F.transform(spots, window)))
    # one scan and hash of the texts; windows of blank lines only repeat by chance
    found = stored(found.filter("has_text").select("key", "digest", "at", "h1", "h2"))
    place = F.struct(F.col("key").isNull().alias("n"), "key", "digest", "at")
    # min and count are taken before the shuffle; stored, so that the join can be split
    # where a third of the windows are the same
    repeated = stored(found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter(
        "n > 1").select("h1", "h2", "first"))
    own = F.col("first.key").eqNullSafe(F.col("key")) & (F.col("first.digest") == F.col("digest"))
    later = found.join(repeated, ["h1", "h2"]).filter(~(own & (F.col("at") < F.col("first.at") + lines)))
    cover = F.explode(F.sequence(F.col("at"), F.col("at") + lines - 1))
    return later.select("key", "digest", cover.alias("line")).groupBy("key", "digest").agg(
        F.array_sort(F.collect_set("line")).alias("covered"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", lines: int = LINES) -> DataFrame:
    """Every row with all its columns, ``text`` without the lines of later window occurrences,
    and ``n_lines, n_removed`` (of the text before), always the last two columns. Where the
    documents have a column of such a name, it stays, and the count's name gets underscores.

    Lines are compared without spaces around them; windows of blank lines only are left
    alone, as is an occurrence that overlaps the kept one in its own document. A text of less
    than three lines has no window; a null text stays null (0 lines). A text that loses all
    its lines becomes empty. Null keys rank last. Rows with equal key and text are one
    document, and get the same result. An empty table gives an empty result.
    """
    columns = docs.columns
    k, t = (f"c{columns.index(c)}" for c in (key, text))
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    cover = covered_lines(rows, k, t, lines).select(
        F.col("key").alias("x_key"), F.col("digest").alias("x_digest"), F.col("covered").alias("x_covered"))
    rows = rows.withColumn("x_own", F.xxhash64(F.col(t)))
    rows = rows.join(cover, F.col(k).eqNullSafe(F.col("x_key")) & (F.col("x_own") == F.col("x_digest")), "left")
    line = F.split(F.col(t), "\n", -1)
    kept = F.array_join(F.filter(line, lambda x, i: ~F.array_contains("x_covered", i)), "\n")
    total = F.when(F.col(t).isNull(), 0).otherwise(F.size(line)).cast("long")
    removed = F.coalesce(F.size("x_covered"), F.lit(0)).cast("long")
    names = []
    for name in ("n_lines", "n_removed"):
        while name in columns:
            name += "_"
        names.append(name)
    shorter = F.when(F.col("x_covered").isNotNull(), kept).otherwise(F.col(t))
    return rows.select(*[(shorter if f"c{i}" == t else F.col(f"c{i}")).alias(c) for i, c in enumerate(columns)],
                       total.alias(names[0]), removed.alias(names[1]))


#: ``dedup_lines`` of the table ``documents`` in DuckDB SQL, given one row for each doc_id.
ORACLE = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS line FROM documents),
w AS (SELECT doc_id, pos, list_transform(line[pos + 1:pos + 3], lambda x: trim(x, ' ')) AS run
      FROM (SELECT doc_id, line, unnest(range(0, len(line) - 2)) AS pos FROM d)),
v AS (SELECT doc_id, pos, run FROM w WHERE run[1] || run[2] || run[3] <> ''),
f AS (SELECT *, first_value(doc_id) OVER o AS first_doc, first_value(pos) OVER o AS first_at
      FROM v WINDOW o AS (PARTITION BY run ORDER BY doc_id NULLS LAST, pos)),
c AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM f
      WHERE NOT (doc_id = first_doc AND pos < first_at + 3)),
l AS (SELECT doc_id, unnest(line) AS part, generate_subscripts(line, 1) - 1 AS pos FROM d),
k AS (SELECT l.doc_id, string_agg(part, chr(10) ORDER BY l.pos) FILTER (c.pos IS NULL) AS text,
             count(*) AS n_lines, count(c.pos) AS n_removed
      FROM l LEFT JOIN c ON l.doc_id = c.doc_id AND l.pos = c.pos GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed
FROM d LEFT JOIN k USING (doc_id)
"""
