"""Sources of a few words beside millions get their target."""

from collections import defaultdict

from pyspark.sql import functions as F

from distillery.llm.mixing import block_words, mix


def test_small_sources_meet_their_target(spark):
    small = {"a50": (10, 5), "b50": (1, 50), "c3": (1, 3), "d300": (30, 10), "e1000": (50, 20), "f3001": (3001, 1)}
    rows = [(f"{s}-{i}", size, s) for s, (n, size) in small.items() for i in range(n)]
    rows += [(f"{s}-{i}", 20_000, s) for s in ("x", "y", "z") for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id string, n int, source string").withColumn("text", F.expr("repeat('w ', n)"))
    got = mix(docs, keep=["doc_id", "source"]).collect()
    block = block_words(1.5 * sum(n for _, n, _ in rows), 9)
    assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r["size"] for r in got)
    taken, facts = defaultdict(int), {r.source: (r.source_size, r.target) for r in got}
    for r in got:
        taken[r.source] += r.taken
    for s, (size, target) in facts.items():
        assert abs(taken[s] - target) <= (0.5 if s in small else block), s
    assert all(r.taken == 2 * r["size"] for r in got if r.source in small)  # all of these are at their bound


def test_a_small_source_below_its_bound(spark):
    """An uncapped small source: whole turns first, then the begin of its stream."""
    rows = [(i, 7, "a") for i in range(13)] + [(100 + i, 20_000, "b") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, n int, source string").withColumn("text", F.expr("repeat('w ', n)"))
    got = [r for r in mix(docs, weights=(1, 40_000), share=1.0, keep=["doc_id", "source"]).collect() if r.source == "a"]
    target = got[0].target
    assert 0 < target < 91 and abs(sum(r.taken for r in got) - target) <= 0.5
    assert sum(0 < r.taken < 7 for r in got) <= 1
