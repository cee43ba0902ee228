"""File stages: inputs that stand alone, stable draws, ordered outputs, exact shards, counts."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from distillery.operators import mining, pairs, teacher
from distillery.plans import embedding, reranker
from distillery.sources import inputs as files
from distillery.sources import jsonl, ordering
from distillery.sources.vectors import VectorStore


def write(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        for r in rows:
            f.write((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n")
    return str(path)


def read_in_order(folder):
    """The lines of a written output, its part files read by name."""
    names = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
    return [json.loads(line) for f in names for line in open(os.path.join(folder, f), encoding="utf-8")]


def one_process(rows, top_k=8, n=4):
    """Triplets of one input in the order a single process writes them."""
    groups = {}
    for r in rows:
        groups.setdefault(r["query"], []).append(r)
    out = []
    for q, ps in groups.items():
        ps = sorted(ps, key=lambda x: -x["score"])
        for i, a in enumerate(ps[:top_k]):
            for b in ps[i + 1:i + 1 + n]:
                if a["passage"] != b["passage"] and a["score"] > b["score"]:
                    out.append((q, a["passage"], b["passage"]))
    return out


def three(q):
    return [{"query": q, "passage": f"{q}{i}", "score": float(3 - i)} for i in range(3)]


def test_inputs_of_equal_names_stand_alone(spark, tmp_path):
    a, b = (write(f"{tmp_path}/{d}/train.jsonl", [dict(r, passage=d + r["passage"]) for r in three("q")]) for d in "ab")
    out = str(tmp_path / "out")
    counts = reranker.create_triplet_files(spark, [a, b, a], out).collect()
    assert {r.output: r.n_triplets for r in counts} == {
        "a__train_margin_sampled.jsonl": 3, "b__train_margin_sampled.jsonl": 3, None: 6}
    for d in "ab":
        rows = read_in_order(f"{out}/output={d}__train_margin_sampled.jsonl")
        assert len(rows) == 3 and all(r["positive"][0] == r["negative"][0] == d for r in rows)
    with pytest.raises(ValueError):
        reranker.create_triplet_files(spark, [a, b], out, on_clash="error")


def test_register(spark, tmp_path):
    write(f"{tmp_path}/x/output=one.jsonl/part-0.json", three("q"))
    write(f"{tmp_path}/x/output=two.jsonl/part-0.json", three("q"))
    write(f"{tmp_path}/x/output=two.jsonl/part-1.json", three("q"))
    got = files.register(spark, [f"{tmp_path}/x/output=*", f"{tmp_path}/none.jsonl"], "_m")
    assert [x.output for x in got] == ["one_m.jsonl", "two_m.jsonl"]
    assert [x.output for x in files.register(spark, f"{tmp_path}/x/output={{one,two}}.json?", "")] == ["one.jsonl", "two.jsonl"]
    assert files.register(spark, []) == []
    with pytest.raises(FileNotFoundError):
        files.register(spark, f"{tmp_path}/none.jsonl", on_missing="error")
    deep = [write(f"{tmp_path}/{d}/same/t.jsonl", three("q")) for d in "pq"]
    assert [x.output for x in files.register(spark, deep)] == ["p__same__t.jsonl", "q__same__t.jsonl"]
    with pytest.raises(ValueError):
        files.register(spark, deep, on_clash="other")


def test_counts_by_reason_and_quarantine(spark, tmp_path):
    bad = ["{broken", '{"query": "q", "passage": "p"}', '{"query": "q", "passage": "p", "score": NaN}',
           '{"query": "q", "passage": "p", "score": "1"}']
    a = write(f"{tmp_path}/a.jsonl", [*three("q"), *bad])
    empty = write(f"{tmp_path}/empty.jsonl", [])
    alone = write(f"{tmp_path}/alone.jsonl", three("q")[:1])
    rows = {r.output: r.asDict() for r in reranker.create_triplet_files(
        spark, [a, empty, alone], str(tmp_path / "out"), "", quarantine_dir=str(tmp_path / "left")).collect()}
    assert rows["a.jsonl"] == {"output": "a.jsonl", "n_triplets": 3, "n_lines": 7, "n_malformed": 2, "n_missing": 1, "n_nan": 1}
    assert rows["empty.jsonl"]["n_lines"] == 0 and rows["alone.jsonl"]["n_triplets"] == 0
    assert rows[None]["n_lines"] == 8
    left = spark.read.json(str(tmp_path / "left")).groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in left} == {"malformed": 2, "missing": 1, "nan": 1}
    assert reranker.create_triplet_files(spark, [], str(tmp_path / "no")).first().n_triplets == 0


@pytest.fixture()
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def scored(n, seed=1):
    rng = random.Random(seed)
    return [{"query": f"q{rng.choice([0, 0, rng.randint(1, 40)])}", "passage": f"p{rng.randint(0, 300)}",
             "score": rng.randint(0, 60) / 4} for _ in range(n)]


def test_random_draw_does_not_know_the_splits(spark, tmp_path, small_splits):
    a, b = (write(f"{tmp_path}/{d}/t.jsonl", scored(900, s)) for d, s in (("a", 1), ("b", 2)))
    got = []
    for i, size in enumerate(("128m", "8k", "3k")):
        small_splits(size)
        out = str(tmp_path / f"o{i}")
        reranker.create_triplet_files(spark, [a, b], out, "", strategy="random", seed=5)
        got.append({d: [tuple(r.values()) for r in read_in_order(f"{out}/output={d}__t.jsonl")] for d in "ab"})
    assert got[0] == got[1] == got[2] and len(got[0]["a"]) > 200


def test_salts_do_not_change_the_draw(spark):
    rows = [("hot" if i % 3 else f"q{i % 50}", f"p{i % 700}", float(i * 37 % 501), i) for i in range(2400)]
    df = spark.createDataFrame(rows, "query string, passage string, score double, seq long").repartition(5)
    want = None
    for per in (10_000, 200, 17):
        t = mining.mine_random_negatives(df, ["query"], "passage", "score", "seq", 8, 4, seed=3, rows_per_salt=per)
        got = sorted(map(tuple, t.collect()))
        assert want is None or got == want
        want = got
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_outputs_are_in_first_seen_order_over_many_files(spark, tmp_path, small_splits):
    rows = scored(1500, 4)
    small_splits("6k")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = str(tmp_path / "o")
        reranker.create_triplet_files(spark, [write(f"{tmp_path}/t.jsonl", rows)], out, "")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    folder = f"{out}/output=t.jsonl"
    assert len([f for f in os.listdir(folder) if f.startswith("part-")]) > 2
    assert [(r["query"], r["positive"], r["negative"]) for r in read_in_order(folder)] == one_process(rows)


def test_scored_pairs_keep_the_input_order(spark, tmp_path, small_splits):
    samples = [{"query": f"q{i}", "positive": [f"a{i}", f"b{i}"], "negative": [f"c{i}"] * (i % 3)} for i in range(400)]
    small_splits("4k")
    out = str(tmp_path / "o")
    size = lambda q, p: np.array([len(x) for x in p], float)
    counts = reranker.generate_scored_pair_files(spark, [write(f"{tmp_path}/s.jsonl", samples)], out, size)
    want = [(s["query"], p) for s in samples for p in s["positive"] + s["negative"]]
    assert [(r["query"], r["passage"]) for r in read_in_order(f"{out}/output=s_scored.jsonl")] == want
    assert {r.output: r.n_pairs for r in counts.collect()} == {"s_scored.jsonl": len(want), None: len(want)}


def test_line_numbers(spark, tmp_path, small_splits):
    a = write(f"{tmp_path}/d/a.jsonl", three("a") * 300)
    write(f"{tmp_path}/d/b.jsonl", three("b") * 200)
    small_splits("2k")
    rows = files.pair_inputs(spark, files.register(spark, f"{tmp_path}/d"))
    got = ordering.with_line_numbers(rows, group=["input"]).orderBy("line").collect()
    assert [r.line for r in got] == list(range(1500))
    assert [r.passage for r in got[:4]] == ["a0", "a1", "a2", "a0"] and got[900].passage == "b0"
    per_file = ordering.with_line_numbers(jsonl.read_lines(spark, a, jsonl.schemas.SCORED_PAIR))
    assert per_file.agg(F.max("line")).first()[0] == 899


def test_every_shard_but_the_last_is_whole(spark, tmp_path):
    df = spark.range(0, 2900).selectExpr("id as query", "id * 7 % 2900 as n").repartition(9)
    for name, order in (("a", ["n"]), ("b", [])):
        jsonl.write_training_shards(df, str(tmp_path / name), 100, order=order)
        files_ = sorted(f for f in os.listdir(tmp_path / name) if f.startswith("part-"))
        sizes = [sum(1 for _ in open(tmp_path / name / f)) for f in files_]
        assert sizes == [100] * 29
    assert [r["n"] for r in read_in_order(tmp_path / "a")] == list(range(2900))
    shards = ordering.in_shards(df, 7, ["n"], shards_per_task=3)
    shards.write.option("maxRecordsPerFile", 7).json(str(tmp_path / "c"))
    sizes = [sum(1 for _ in open(tmp_path / "c" / f)) for f in sorted(os.listdir(tmp_path / "c")) if f.startswith("part-")]
    assert sizes == [7] * 414 + [2]
    jsonl.write_training_shards(df.limit(0), str(tmp_path / "none"), 10)
    with pytest.raises(ValueError):
        jsonl.write_training_shards(df, str(tmp_path / "x"), 0)


def test_each_text_is_embedded_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)
    embed = teacher.hashing_embedder(16)

    def counting(texts):
        calls.add(len(texts))
        return embed(texts)

    samples = [{"query": "q", "positive": ["a", "b"], "negative": ["c", "a", None]}, {"query": "a", "positive": ["q"], "negative": ["b", ""]},
               {"query": "", "positive": ["zzz"], "negative": ["y"]}]
    path = write(f"{tmp_path}/s.jsonl", samples)
    store = VectorStore(spark, str(tmp_path / "vectors"))
    got = embedding.embed_and_label(jsonl.read_samples(spark, path, "truthy"), counting, store)
    # "q" x ("a", "b") x ("c", "a"), "a" x "q" x ("b", "")
    assert got[0].count() == 6 and got[1].count() == 0
    assert calls.value == 5  # q a b c and the empty text
    more = write(f"{tmp_path}/t.jsonl", [{"query": "q", "positive": ["new"], "negative": ["c"]}])
    counts, missing = embedding.generate_soft_label_files(spark, [path, more], str(tmp_path / "o"), counting, store=store)
    assert calls.value == 6  # only the new one
    assert {r.output: (r.n_triplets, r.n_texts) for r in counts.collect()} == {
        "s_soft_labels.jsonl": (6, 5), "t_soft_labels.jsonl": (1, 3), None: (7, 8)}
    assert missing.count() == 0
    first = read_in_order(f"{tmp_path}/o/output=s_soft_labels.jsonl")
    assert [(r["query"], r["positive"], r["negative"]) for r in first] == [
        ("q", "a", "c"), ("q", "a", "a"), ("q", "b", "c"), ("q", "b", "a"), ("a", "q", "b"), ("a", "q", "")]
    assert store.table().count() == 6


def test_product_of_a_hot_sample_in_blocks(spark):
    rows = [(0, "positive", i) for i in range(60)] + [(0, "negative", i) for i in range(90)]
    rows += [(k, s, i) for k in range(1, 100) for s, n in (("positive", 2), ("negative", k % 3)) for i in range(n)]
    p = spark.createDataFrame(rows, "k long, side string, pos int").repartition(4)
    plain = pairs.cross_sides(p, ["k"], block_rows=None)
    grid = pairs.cross_sides(p, ["k"], block_rows=10)
    assert sorted(map(tuple, grid.collect())) == sorted(map(tuple, plain.collect()))
    # a block of the hot sample: 60 positives in 6 parts, 90 negatives in 9
    keys = [c for c in ("_bp", "_bn")]
    text = grid._jdf.queryExecution().optimizedPlan().toString()
    assert all(c in text for c in keys)


def test_length_batches():
    lengths = np.array([5, 900, 3, 7, 100, 8, 2, 6])
    got = [b.tolist() for b in teacher.length_batches(lengths, 3, 300)]
    assert got == [[6, 2, 0], [7, 3, 5], [4], [1]]
    assert [len(b) for b in teacher.length_batches(np.full(10, 4), 100, 12)] == [3, 3, 3, 1]
    assert list(teacher.length_batches(np.array([], int), 3, 3)) == []


def test_prompts_are_scored_in_batches_and_keep_their_order(spark):
    rows = [(i, "x" * (i * 37 % 200)) for i in range(500)] + [(500, "")]
    df = spark.createDataFrame(rows, "id long, prompt string").coalesce(1)
    seen = teacher.score_prompts(df, teacher.stand_in_teacher, ["id"], max_length=50, batch_size=4, sort_rows=64).collect()
    suffix = [ord(c) for c in teacher.ASSISTANT_SUFFIX]
    tell = teacher.stand_in_teacher()
    assert [r.id for r in seen] == [r[0] for r in rows]
    for r, (_, text) in zip(seen, rows):
        ids = np.array([ord(c) for c in text[:50]] + suffix)
        told = tell([ids])[0]
        assert r.n_ids == len(ids) and r.score == pytest.approx(told.get("yes", -10.0) - told.get("no", -10.0))
    with pytest.raises(ValueError):
        teacher.score_prompts(df, teacher.stand_in_teacher, ["id"], batch_size=0)


def test_teacher_stage_over_files(spark, tmp_path):
    path = write(f"{tmp_path}/s.jsonl", [{"query": "q", "positive": ["a"], "negative": ["b" * 300, "c"]}])
    out = str(tmp_path / "o")
    reranker.generate_scored_pair_files(spark, [path], out, None, teacher_loader=teacher.stand_in_teacher,
                                        instruction="find", max_length=100)
    rows = read_in_order(f"{out}/output=s_scored.jsonl")
    assert [r["passage"] for r in rows] == ["a", "b" * 300, "c"] and all(isinstance(r["score"], float) for r in rows)
