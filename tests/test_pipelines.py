"""End-to-end pipelines over small JSONL files, checked against plain Python."""

import itertools
import json
import os

import numpy as np
import pytest

from distillery.operators import teacher
from distillery.plans import embedding, evaluation, reranker
from distillery.sources import jsonl
from distillery.streaming import files as streaming


def write(path, objs):
    with open(path, "w", encoding="utf-8") as f:
        for o in objs:
            f.write(json.dumps(o, ensure_ascii=False) + "\n")
    return str(path)


SAMPLES = [
    {"query": "what is spark", "positive": ["spark is an engine", "a cluster engine"],
     "negative": ["a fire spark", "spark is an engine", "plugs"]},
    {"query": "pandas", "positive": ["a dataframe library"], "negative": ["bears", "zoo animal"]},
    {"query": "", "positive": ["x"], "negative": ["y"]},
    {"query": "no negatives", "positive": ["x"], "negative": []},
]


def test_embedding_pipeline_matches_python(spark, tmp_path):
    p = write(tmp_path / "s.jsonl", SAMPLES)
    samples = jsonl.read_samples(spark, [p], mode="truthy")
    scored, missing = embedding.embed_and_label(samples)
    got = sorted((r.query, r.positive, r.negative, round(r.label[0], 6), round(r.label[1], 6))
                 for r in scored.collect())
    emb = teacher.hashing_embedder()
    expect = []
    for s in SAMPLES:
        if not (s["query"] and s["positive"] and s["negative"]):
            continue
        for pos, neg in itertools.product(s["positive"], s["negative"]):
            v = emb(__import__("pandas").Series([s["query"], pos, neg])).astype(np.float64)
            cos = lambda a, b: float(a @ b / (max(np.linalg.norm(a), 1e-8) * max(np.linalg.norm(b), 1e-8)))
            expect.append((s["query"], pos, neg, round(cos(v[0], v[1]), 6), round(cos(v[0], v[2]), 6)))
    assert got == sorted(expect)
    assert missing.count() == 0
    rec = embedding.soft_label_records(scored)
    assert dict(rec.dtypes)["label"] == "array<float>"


def test_missing_vectors_reported(spark, tmp_path):
    p = write(tmp_path / "s.jsonl", SAMPLES[:2])
    samples = jsonl.read_samples(spark, [p], mode="truthy")
    vecs = spark.createDataFrame([(t, [1.0, float(i)]) for i, t in enumerate(
        ["what is spark", "spark is an engine", "a cluster engine", "a fire spark", "plugs"])],
        "text string, embedding array<double>")
    scored, missing = embedding.soft_label_triplets(samples, vecs)
    assert scored.count() == 6          # query 1: 2 x 3
    assert missing.count() == 2         # 'pandas' has no vector


def test_reranker_files_end_to_end(spark, tmp_path):
    rows_a = [{"query": "q1", "passage": f"p{i}", "score": float(10 - i)} for i in range(6)]
    rows_a += [{"query": "q2", "passage": "only", "score": 1.0}, {"query": "q1", "passage": "p0", "score": 0.5}]
    rows_b = [{"query": "q1", "passage": f"p{i}", "score": float(i)} for i in range(3)]
    a = write(tmp_path / "train_logit.jsonl", rows_a)
    b = write(tmp_path / "test_logit.jsonl", rows_b + ["oops"] if False else rows_b)
    out = str(tmp_path / "triplets")
    counts = {r.output: r.n_triplets for r in reranker.create_triplet_files(spark, [a, b], out, top_k=2,
                                                                           num_negatives=2).collect()}
    # file a, q1 ranks: p0(10) p1 p2 p3 p4 p5 p0(0.5): pos p0 -> p1,p2 ; pos p1 -> p2,p3
    assert counts["train_logit_margin_sampled.jsonl"] == 4
    # file b is separate: ranks p2 p1 p0 -> (p2,p1),(p2,p0),(p1,p0)
    assert counts["test_logit_margin_sampled.jsonl"] == 3
    assert counts[None] == 7
    assert os.path.isdir(os.path.join(out, "output=train_logit_margin_sampled.jsonl"))


def test_logprob_teacher_and_evaluation(spark, tmp_path):
    p = write(tmp_path / "s.jsonl", SAMPLES[:2])
    samples = jsonl.read_samples(spark, [p], mode="strict")
    pairs = reranker.sample_pairs(samples)
    assert pairs.count() == 8
    judged = evaluation.judged_from_samples(samples, domain="d")
    from pyspark.sql import functions as F
    judged = judged.withColumn("before", F.length("passage").cast("double")).withColumn(
        "after", F.col("rel").cast("double"))
    rep, cmp = evaluation.evaluation_report(judged)
    vals = {(r.model, r.metric): r.value for r in rep.collect()}
    assert vals[("after", "map")] == pytest.approx(1.0)
    assert cmp.count() == 3


def test_streaming_pairs_and_triplets(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    write(src / "a.jsonl", SAMPLES[:2])
    q = streaming.start_pair_stream(spark, str(src), str(tmp_path / "pairs"), str(tmp_path / "ck1"))
    q.awaitTermination(120)
    assert spark.read.json(str(tmp_path / "pairs")).count() == 8
    sp = tmp_path / "scored"
    sp.mkdir()
    write(sp / "x.jsonl", [{"query": "q", "passage": f"p{i}", "score": float(i)} for i in range(5)])
    q2 = streaming.start_triplet_stream(spark, str(sp), str(tmp_path / "trip"), str(tmp_path / "ck2"), 2, 2)
    q2.awaitTermination(120)
    assert spark.read.json(str(tmp_path / "trip")).count() == 4


def test_student_models_evaluation(spark, tmp_path):
    p = write(tmp_path / "s.jsonl", SAMPLES)
    samples = jsonl.read_samples(spark, [p], mode="strict")
    judged = evaluation.judged_from_samples(samples, domain="test")
    scorers = {
        "before": evaluation.bi_encoder_scorer(teacher.hashing_embedder(ngram=2)),
        "after": evaluation.bi_encoder_scorer(teacher.hashing_embedder(ngram=3)),
    }
    scored = evaluation.score_with_models(judged, scorers)
    assert scored.count() == judged.count() == 11
    # cross-encoder convention keeps samples with an empty side
    rep, cmp = evaluation.evaluation_report(scored, empty_side="zero")
    vals = rep.collect()
    assert len(vals) == 6 and all(0.0 <= r.value <= 1.0 for r in vals)
    assert {r.metric_label for r in cmp.collect()} == {"MAP", "MRR@10", "NDCG@10"}


def test_file_stages_end_to_end(spark, tmp_path):
    """Samples -> scored pairs -> margin triplets; samples -> soft labels; evaluation."""
    a = write(tmp_path / "train.jsonl", SAMPLES)
    b = write(tmp_path / "test.jsonl", SAMPLES[:2])
    lexical = lambda q, p: np.array([len(set(x.split()) & set(y.split())) for x, y in zip(q, p)], dtype=float)
    counts = {r.output: r.n_pairs for r in reranker.generate_scored_pair_files(
        spark, [a, b], str(tmp_path / "scored"), lexical, "_logit").collect()}
    assert counts == {"train_logit.jsonl": 11, "test_logit.jsonl": 8, None: 19}
    scored_files = [os.path.join(tmp_path, "scored", f"output={n}") for n in ("train_logit.jsonl", "test_logit.jsonl")]
    tri = {r.output: r.n_triplets for r in reranker.create_triplet_files(
        spark, scored_files, str(tmp_path / "trip"), "_margin").collect()}
    assert tri[None] >= 1 and set(tri) == {"train_logit_margin.jsonl", "test_logit_margin.jsonl", None}
    soft_counts, missing = embedding.generate_soft_label_files(spark, [a], str(tmp_path / "soft"))
    assert {r.output: r.n_triplets for r in soft_counts.collect()}["train_soft_labels.jsonl"] == 8
    assert missing.count() == 0
    rep, cmp = evaluation.evaluate_files(spark, [b], {
        "before": evaluation.bi_encoder_scorer(teacher.hashing_embedder(ngram=2)),
        "after": lexical,
    })
    assert rep.count() == 6 and cmp.count() == 3


def test_streaming_triplets_per_file(spark, tmp_path):
    """Two files with the same query, mined as they arrive: queries never merge across files."""
    sp = tmp_path / "scored"
    sp.mkdir()
    write(sp / "a.jsonl", [{"query": "q", "passage": f"a{i}", "score": float(i)} for i in range(3)])
    write(sp / "b.jsonl", [{"query": "q", "passage": f"b{i}", "score": float(10 + i)} for i in range(3)])
    q = streaming.start_triplet_stream(spark, str(sp), str(tmp_path / "trip"), str(tmp_path / "ck"), 8, 4)
    q.awaitTermination(180)
    rows = spark.read.json(str(tmp_path / "trip")).collect()
    # each file alone: 3 candidates -> (2,1), (2,0), (1,0); a merged query would pair a* with b*
    assert len(rows) == 6
    assert all(r.positive[0] == r.negative[0] for r in rows)


def test_strategy_switch_random_and_ordered(spark, tmp_path):
    rows = [{"query": "q1", "passage": f"p{i}", "score": float(20 - i)} for i in range(12)]
    rows += [{"query": "q0", "passage": f"r{i}", "score": float(i)} for i in range(3)]
    good, _ = jsonl.read_scored_pairs(spark, [write(tmp_path / "s.jsonl", rows)])
    rnd = reranker.margin_triplets(good, top_k=3, num_negatives=2, strategy="random", seed=1).collect()
    assert {r.query for r in rnd} == {"q0", "q1"}
    assert all(r.score > 0 for r in rnd)
    per_pos = {}
    for r in rnd:
        per_pos[(r.query, r.pos_rank)] = per_pos.get((r.query, r.pos_rank), 0) + 1
    assert max(per_pos.values()) <= 2
    ordered = reranker.margin_triplets(good, top_k=2, num_negatives=1, ordered=True).collect()
    # first-seen query order (q1 appears first in the file), then positive rank
    assert [(r.query, r.pos_rank) for r in ordered] == [("q1", 1), ("q1", 2), ("q0", 1), ("q0", 2)]
    with pytest.raises(ValueError):
        reranker.margin_triplets(good, strategy="other")


def test_query_spread_over_part_files_is_one_query(spark, tmp_path):
    """One query on many lines: the same triplets from one part file as from many."""
    from distillery.plans.reranker import create_triplet_files, margin_triplets
    from distillery.sources import jsonl

    pairs = spark.createDataFrame([("q", f"p{i:03d}", float(i * 37 % 200)) for i in range(200)],
                                  "query string, passage string, score double")
    got = []
    for parts in (1, 4):
        path = str(tmp_path / f"{parts}/output=in.jsonl")
        pairs.repartitionByRange(parts, "passage").sortWithinPartitions("passage").write.json(path)
        good, _ = jsonl.read_scored_pairs(spark, [path])
        got.append(sorted(tuple(r) for r in margin_triplets(good, 8, 4).select(
            "query", "positive", "negative", "score").collect()))
    assert got[0] == got[1] and len(got[0]) == 32
    out = str(tmp_path / "out")
    other = str(tmp_path / "b/output=other.jsonl")
    pairs.write.json(other)
    one = create_triplet_files(spark, [str(tmp_path / "4/output=in.jsonl")], out)
    assert {r.output: r.n_triplets for r in one.collect()}[None] == 32
    create_triplet_files(spark, [other], out)
    assert {r.output for r in jsonl.written_outputs(spark, out).distinct().collect()} == {
        "in_margin_sampled.jsonl", "other_margin_sampled.jsonl"}
    single = str(tmp_path / "c/output=single.jsonl")
    pairs.limit(1).write.json(single)
    none = create_triplet_files(spark, [single], str(tmp_path / "none"))
    assert sum(r.n_triplets for r in none.collect()) == 0
