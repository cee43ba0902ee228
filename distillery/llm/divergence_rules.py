"""Quality rules by distribution divergence. DataFrame operations only.

A document's histograms of character classes and of common words are compared, by
Jensen-Shannon distance, to the references of its language: the same histograms over all
texts of that language. Short texts have noisy histograms, so each comparison has its own
minimum length. A language with too few words has no reference; its texts, like those without
a language, are held against the nearest of all references (each language's, and that of all
texts together).

References are aggregations over the whole corpus (pre-aggregated before the shuffle), a row a
language with a fixed number of common words. Everything about a document is computed within
its row, so no text is shuffled and no key needs to be unique; the classes, counted once, are
stored without the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from distillery.llm.common import stored

SPACE = r"\x20\x09-\x0D"
SYMBOLS = "[#*$%&|<>]"
#: Character classes; the last class is what is left of the words.
CLASSES = (r"\p{Ll}+", r"\p{Lu}+", r"[\p{Lt}\p{Lm}\p{Lo}]+", r"\p{N}+", r"\p{P}+")
#: Common words of a reference.
COMMON = 32
#: Words that a language needs for a reference, and a text to count in one.
REFERENCE_WORDS, TEXT_WORDS = 10_000, 50
#: Greatest distances (0 to 1), and the words from which on each is asked for.
MAX_CLASS_DISTANCE, CLASS_WORDS = 0.28, 50
MAX_WORD_DISTANCE, WORD_WORDS = 0.42, 50
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def _with(value: Column, function: Callable[[Column], Column]) -> Column:
    """``function`` of a value that is computed once, however often the function names it."""
    return F.transform(F.array(value), function)[0]


def _repeated_words(windows: Column) -> Column:
    """How many words lie in a window (by its digest) found twice or more, the first included."""
    twice = lambda s: F.array_distinct(F.filter(s, lambda h, i: h == F.get(s, i - 1)))

    def few(again: Column) -> Column:
        return F.filter(F.transform(windows, lambda h, i: F.when(F.array_contains(again, h), i)), lambda at: at.isNotNull())

    def many(s: Column) -> Column:
        same = lambda j, x: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, i: same(i - 1, x) | same(i + 1, x)), lambda x: x["at"]))

    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    step = lambda a, at: F.struct(at.alias("last"), (a["n"] + F.least(F.lit(3), at - a["last"])).alias("n"))
    count = lambda spots: F.aggregate(spots, start, step, lambda a: a["n"])
    spots = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    # a few repeated digests are looked up one by one, many by sorting positions: the same result
    covered = _with(_with(F.sort_array(windows), twice), lambda again: F.when(
        F.size(again) <= 24, count(few(again))).otherwise(count(_with(spots, many))))
    # most short texts repeat no window: the distinct digests tell so without a sort
    return F.when(F.size(windows) > F.size(F.array_distinct(windows)), covered).otherwise(F.lit(0).cast("long"))


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``x_words`` (the words in order), ``n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words`` and ``x_classes`` (code points by character class)."""
    rows = docs.withColumn("x_text", F.coalesce(F.col(text), F.lit("")))
    rows = rows.withColumn("x_words", F.array_remove(F.split("x_text", f"[{SPACE}]+", -1), ""))
    said = F.filter(F.split("x_text", "\n", -1), lambda x: x.rlike(f"[^{SPACE}]"))
    size = F.size("x_words")
    windows = F.when(size >= 3, F.transform(F.slice("x_words", F.lit(1), F.greatest(size - 2, F.lit(0))), lambda w, i: F.xxhash64(
        w, F.get(F.col("x_words"), i + 1), F.get(F.col("x_words"), i + 2)))).otherwise(F.array().cast("array<long>"))
    rows = rows.select(
        *docs.columns, "x_words", size.cast("long").alias("n_words"),
        F.length(F.array_join("x_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("x_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        _with(said, lambda s: F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines"),
        _with(windows, _repeated_words).cast("long").alias("n_repeat_words"), F.col("x_text").alias("x_left0"))
    # each class is taken out of what the classes before have left, so later passes are short
    for i, p in enumerate(CLASSES):
        rows = rows.withColumn(f"x_left{i + 1}", F.regexp_replace(f"x_left{i}", p, ""))
    sizes = [F.length(f"x_left{i}") - F.length(f"x_left{i + 1}") for i in range(len(CLASSES))]
    rest = F.length(F.regexp_replace(f"x_left{len(CLASSES)}", f"[{SPACE}]+", ""))
    return rows.withColumn("x_classes", F.array(*sizes, rest).cast("array<long>")).drop(
        *[f"x_left{i}" for i in range(len(CLASSES) + 1)])


def word_references(docs: DataFrame, text: str = "text", lang: str = "lang", common: int = COMMON,
                    least_words: int = REFERENCE_WORDS, text_words: int = TEXT_WORDS) -> DataFrame:
    """A row a language with at least ``least_words`` words, and one (null language) for all
    texts: ``x_lang, common`` (its most frequent words, ties to the smaller) and
    ``common_part`` (their share of all words, then the rest's). Texts under ``text_words`` words
    don't count. An empty table has the row for all texts, without words."""
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.array_remove(
        F.split(F.coalesce(F.col(text), F.lit("")), f"[{SPACE}]+", -1), "").alias("words")).filter(F.size("words") >= text_words)
    per_word = stored(rows.select("lang", F.explode("words").alias("word")).groupBy("lang", "word").agg(
        F.count(F.lit(1)).alias("n")))
    sums = per_word.groupBy("lang").agg(F.sum("n").alias("total"))
    big = sums.filter(F.col("lang").isNotNull() & (F.col("total") >= least_words))
    everything = sums.agg(F.lit(None).cast("string").alias("lang"), F.coalesce(F.sum("total"), F.lit(0)).alias("total"))
    totals = big.unionByName(everything)
    all_words = per_word.groupBy("word").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "word", "n")
    words = per_word.join(big.select("lang"), "lang").select("lang", "word", "n").unionByName(all_words)
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = words.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= common)
    lists = top.groupBy(F.col("lang").alias("l")).agg(F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("list"))
    lists = totals.join(lists, F.col("lang").eqNullSafe(F.col("l")), "left").select(
        F.col("lang").alias("x_lang"), F.coalesce(F.transform("list", lambda x: x["word"]), F.array().cast(
            "array<string>")).alias("common"), F.coalesce(F.transform("list", lambda x: x["n"] / F.col("total")), F.array().cast(
                "array<double>")).alias("part"))
    rest = F.greatest(F.lit(1.0) - F.aggregate("part", F.lit(0.0), lambda a, x: a + x), F.lit(0.0))
    return lists.select("x_lang", "common", F.concat("part", F.array(rest)).alias("common_part"))


def class_references(measured: DataFrame, text_words: int = TEXT_WORDS) -> DataFrame:
    """``c_lang, class_part``: the character classes of each language of ``measured`` (by
    ``x_held``), and (null language) of all its texts, those under ``text_words`` words left out."""
    n = len(CLASSES) + 1
    rows = measured.filter(F.col("n_words") >= text_words).select(
        "x_held", *[F.col("x_classes")[i].alias(f"k{i}") for i in range(n)])
    per = rows.groupBy("x_held").agg(*[F.sum(f"k{i}").alias(f"k{i}") for i in range(n)])
    both = per.filter("x_held is not null").unionByName(per.agg(F.lit(None).cast("string").alias("x_held"), *[
        F.coalesce(F.sum(f"k{i}"), F.lit(0)).alias(f"k{i}") for i in range(n)]))
    whole = sum((F.col(f"k{i}") for i in range(n)), F.lit(0))
    return both.select(F.col("x_held").alias("c_lang"), F.array(*[
        F.coalesce(F.try_divide(F.col(f"k{i}").cast("double"), whole), F.lit(0.0)) for i in range(n)]).alias("class_part"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms whose entries add up to 1."""
    side = lambda a, b: F.when(a > 0, a * F.ln(2 * a / (a + b))).otherwise(F.lit(0.0))
    total = F.aggregate(F.zip_with(p, q, lambda a, b: side(a, b) + side(b, a)), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(total / 2 / F.ln(F.lit(2.0)), F.lit(0.0)))


def _candidates(refs: DataFrame, lang: str, *fields: str) -> DataFrame:
    """``x_for, x_refs``: the references that a text of a language is held against: its own, or,
    without a language, all (as many as there are languages)."""
    one = F.struct(*fields)
    each = refs.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("x_for"), F.array(one).alias("x_refs"))
    return each.unionByName(refs.agg(F.collect_list(one).alias("x_refs")).select(
        F.lit(None).cast("string").alias("x_for"), "x_refs"))


def measure(docs: DataFrame, refs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
            keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` as ``c0, c1, ...``, the counts, ``x_classes``, ``x_held`` (the language
    whose reference applies; null: the nearest) and ``wd`` (distance of the common words)."""
    keep = list(keep or [key])
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.col(text).alias("x_t"),
                       F.col(lang).cast("string").alias("x_l"))
    rows = counts(rows, "x_t").drop("x_t")
    known = refs.filter("x_lang is not null").select(F.col("x_lang").alias("l"), F.lit(True).alias("known"))
    rows = rows.join(known, F.col("x_l") == F.col("l"), "left").withColumn(
        "x_held", F.when(F.col("known"), F.col("x_l"))).drop("l", "known", "x_l")
    rows = rows.join(_candidates(refs, "x_lang", "common", "common_part"), F.col("x_held").eqNullSafe(F.col("x_for")), "left").drop("x_for")
    # the references' words: a fixed number for each language
    common = [r[0] for r in refs.select(F.explode("common")).distinct().collect()]
    rows = rows.withColumn("x_words", F.filter("x_words", lambda w: w.isin(common)) if common else F.array().cast("array<string>"))
    rest = lambda p: F.greatest(F.lit(1.0) - F.aggregate(p, F.lit(0.0), lambda a, x: a + x), F.lit(0.0))

    def distance(ref: Column) -> Column:
        part = F.transform(ref["common"], lambda w: (F.size("x_words") - F.size(F.array_remove("x_words", w))) / F.col("n_words"))
        return _with(part, lambda p: js_distance(F.concat(p, F.array(rest(p))), ref["common_part"]))

    told = F.filter("x_refs", lambda r: F.size(r["common"]) > 0)
    wd = F.when(F.col("n_words") >= WORD_WORDS, F.array_min(F.transform(told, distance)))
    return rows.withColumn("wd", wd).drop("x_refs", "x_words")


def quality(docs: DataFrame, refs: DataFrame, classes: DataFrame | None = None, key: str = "doc_id", text: str = "text",
            lang: str = "lang", max_class_distance: float = MAX_CLASS_DISTANCE,
            max_word_distance: float = MAX_WORD_DISTANCE, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: the key) and ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, class_distance, word_distance`` of every row.

    ``refs`` and ``classes`` are references of common words and of character classes; without
    ``classes``, the documents themselves are taken. A distance is null where the text is too
    short for it (``CLASS_WORDS, WORD_WORDS``), or if a reference is empty; a null distance speaks
    against no text. A null or empty text has no words and fails the base rules. Repeated rows
    and null keys get a row each; a null language, or one without a reference, is held against
    the nearest reference. Other columns, whatever their names, aren't touched. An empty table gives an
    empty result.
    """
    keep = list(keep or [key])
    rows = stored(measure(docs, refs, key, text, lang, keep))
    classes = class_references(rows) if classes is None else classes
    rows = rows.join(_candidates(stored(classes), "c_lang", "class_part"), F.col("x_held").eqNullSafe(F.col("x_for")), "left")
    shares = F.transform("x_classes", lambda n: n / F.col("word_chars"))
    told = F.filter("x_refs", lambda r: F.aggregate(r["class_part"], F.lit(0.0), lambda a, x: a + x) > 0)
    cd = F.when(F.col("n_words") >= CLASS_WORDS, F.array_min(F.transform(told, lambda r: js_distance(shares, r["class_part"]))))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = rows.select("*", failed.alias("failed"), cd.alias("cd"))
    fits = F.coalesce(F.col("cd") <= max_class_distance, F.lit(True)) & F.coalesce(F.col("wd") <= max_word_distance, F.lit(True))
    return rows.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", F.col("failed").alias("base_failed"), (~F.col("failed") & fits).alias("kept"),
        F.round("cd", 6).alias("class_distance"), F.round("wd", 6).alias("word_distance"))


#: ``quality(documents, word_references(documents))`` in DuckDB SQL.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS word,
         string_split(coalesce(text, ''), chr(10)) AS line FROM documents),
c AS (SELECT row_id, doc_id, lang, word, len(word)::BIGINT AS n_words, coalesce(len(array_to_string(word, '')), 0)::BIGINT AS word_chars,
             list_filter(line, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS said,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             [length(regexp_replace(text, '\P{Ll}+', '', 'g')), length(regexp_replace(text, '\P{Lu}+', '', 'g')),
              length(regexp_replace(text, '[^\p{Lt}\p{Lm}\p{Lo}]+', '', 'g')), length(regexp_replace(text, '\P{N}+', '', 'g')),
              length(regexp_replace(text, '\P{P}+', '', 'g'))] AS named FROM d),
f AS (SELECT row_id, doc_id, lang, n_words, word_chars, n_symbols, (len(said) - len(list_distinct(said)))::BIGINT AS n_dup_lines,
             list_concat(named, [greatest(word_chars - list_sum(named)::BIGINT, 0)]) AS classes FROM c),
t AS (SELECT row_id, lang, n_words, unnest(word) AS w, generate_subscripts(word, 1) AS pos FROM c),
win AS (SELECT row_id, pos, hash(w, lead(w, 1) OVER o, lead(w, 2) OVER o) AS h, pos <= n_words - 2 AS whole
        FROM t WINDOW o AS (PARTITION BY row_id ORDER BY pos)),
dup AS (SELECT row_id, h FROM win WHERE whole GROUP BY row_id, h HAVING count(*) > 1),
rep AS (SELECT row_id, count(DISTINCT p) AS n_repeat_words FROM (
          SELECT row_id, unnest([pos, pos + 1, pos + 2]) AS p FROM win JOIN dup USING (row_id, h) WHERE whole) GROUP BY row_id),
by_row AS (SELECT row_id, lang, n_words, w, count(*) AS n FROM t GROUP BY ALL),
per AS (SELECT lang, w, sum(n)::BIGINT AS n FROM by_row WHERE n_words >= 50 GROUP BY ALL),
big AS (SELECT lang FROM per WHERE lang IS NOT NULL GROUP BY lang HAVING sum(n) >= 10000),
some_words AS (SELECT lang, w, n FROM per WHERE lang IN (FROM big) UNION ALL SELECT NULL, w, sum(n)::BIGINT FROM per GROUP BY w),
top AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, w) AS rank FROM some_words QUALIFY rank <= 32),
tot AS (SELECT lang, sum(n)::BIGINT AS total FROM some_words GROUP BY lang),
part AS (SELECT top.lang, w, rank, n::DOUBLE / total AS q FROM top JOIN tot ON top.lang IS NOT DISTINCT FROM tot.lang),
sums AS (SELECT lang, classes FROM f WHERE n_words >= 50 AND lang IN (FROM big) UNION ALL SELECT NULL, classes FROM f WHERE n_words >= 50),
cref AS (SELECT lang, list_transform(s, lambda x: x::DOUBLE / list_sum(s)) AS cq FROM (
           SELECT lang, [sum(classes[1]), sum(classes[2]), sum(classes[3]), sum(classes[4]), sum(classes[5]), sum(classes[6])] AS s
           FROM sums GROUP BY lang)),
e AS (SELECT row_id, n_words, CASE WHEN lang IN (FROM big) THEN lang END AS held FROM f),
-- a text is held against its language's reference, or the nearest of all
for_ref AS (SELECT DISTINCT lang AS ref, lang AS held FROM part WHERE lang IS NOT NULL UNION ALL SELECT DISTINCT lang, NULL FROM part),
hist AS (SELECT e.row_id, ref, rank, q, coalesce(b.n, 0)::DOUBLE / e.n_words AS p
         FROM e JOIN for_ref ON e.held IS NOT DISTINCT FROM for_ref.held JOIN part ON ref IS NOT DISTINCT FROM part.lang
         LEFT JOIN by_row b ON b.row_id = e.row_id AND b.w = part.w WHERE e.n_words >= 50),
rest AS (SELECT row_id, ref, greatest(1 - sum(p ORDER BY rank), 0) AS p, greatest(1 - sum(q ORDER BY rank), 0) AS q FROM hist GROUP BY ALL),
terms AS (SELECT row_id, ref, p, q FROM hist UNION ALL FROM rest),
wd AS (SELECT row_id, min(d) AS wd FROM (
         SELECT row_id, ref, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END
                                     + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END) / 2 / ln(2), 0)) AS d FROM terms GROUP BY ALL)
       GROUP BY row_id),
cd AS (SELECT e.row_id, min(sqrt(greatest(list_sum(list_transform(list_zip(list_transform(classes, lambda x: x::DOUBLE / word_chars), cq), lambda z:
                CASE WHEN z[1] > 0 THEN z[1] * ln(2 * z[1] / (z[1] + z[2])) ELSE 0 END
                + CASE WHEN z[2] > 0 THEN z[2] * ln(2 * z[2] / (z[1] + z[2])) ELSE 0 END)) / 2 / ln(2), 0))) AS cd
       FROM e JOIN f USING (row_id) JOIN cref ON held = cref.lang OR held IS NULL WHERE e.n_words >= 50 GROUP BY e.row_id),
all_rows AS (SELECT f.*, coalesce(n_repeat_words, 0) AS n_repeat_words, cd, wd,
                    n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed
             FROM f LEFT JOIN rep USING (row_id) LEFT JOIN cd USING (row_id) LEFT JOIN wd USING (row_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(cd <= 0.28, true) AND coalesce(wd <= 0.42, true) AS kept,
       round(cd, 6) AS class_distance, round(wd, 6) AS word_distance
FROM all_rows
"""
