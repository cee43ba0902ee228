"""Per-query AP / RR@k / NDCG@k against brute force with heavy ties."""

import math
import random

import pytest

from distillery.operators import metrics


def brute(cands, k=10):
    """cands: list of (score, rel, idx). Tie-aware AP/NDCG, RR by (score desc, idx)."""
    n_rel = sum(r for _, r, _ in cands)
    order = sorted(cands, key=lambda c: (-c[0], c[2]))
    ap = 0.0
    for s, r, _ in cands:
        if r:
            ge = [c for c in cands if c[0] >= s]
            ap += sum(c[1] for c in ge) / len(ge)
    ap = ap / n_rel if n_rel else None
    rr = 0.0
    for i, (s, r, _) in enumerate(order[:k]):
        if r:
            rr = 1.0 / (i + 1)
            break
    dcg = 0.0
    for i, (s, r, _) in enumerate(order[:k]):
        tie = [c[1] for c in cands if c[0] == s]
        dcg += (sum(tie) / len(tie)) / math.log2(i + 2)
    ideal = sorted([c[1] for c in cands], reverse=True)
    idcg = sum(r / math.log2(i + 2) for i, r in enumerate(ideal[:k]))
    return ap, rr, (dcg / idcg if idcg else None)


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows, expect = [], {}
    for q in range(60):
        cands = [(float(rng.randint(0, 4)), rng.randint(0, 1), i) for i in range(rng.randint(1, 25))]
        for s, r, i in cands:
            rows.append((q, s, r, i))
        expect[q] = brute(cands)
    df = spark.createDataFrame(rows, "qid long, score double, rel int, seq long").repartition(5)
    got = metrics.per_query_metrics(df, ["qid"], empty_side="zero").collect()
    assert len(got) == 60
    for r in got:
        ap, rr, nd = expect[r.qid]
        assert r.ap == pytest.approx(ap or 0.0, abs=1e-9)
        assert r.rr == pytest.approx(rr, abs=1e-9)
        assert r.ndcg == pytest.approx(nd or 0.0, abs=1e-9)


def test_empty_side_modes(spark):
    rows = [(1, 0.9, 1, 0), (1, 0.1, 0, 1), (2, 0.5, 0, 0), (2, 0.4, 0, 1), (3, 0.5, 1, 0)]
    df = spark.createDataFrame(rows, "qid long, score double, rel int, seq long")
    drop = {r.qid for r in metrics.per_query_metrics(df, ["qid"], empty_side="drop").collect()}
    assert drop == {1}
    zero = {r.qid: r for r in metrics.per_query_metrics(df, ["qid"], empty_side="zero").collect()}
    assert set(zero) == {1, 2, 3}
    assert zero[2].ap == 0.0 and zero[2].rr == 0.0 and zero[2].ndcg == 0.0
    assert zero[3].ap == 1.0


def test_report_shape(spark):
    rows = [(q, "in" if q % 2 else "out", float(i), float(-i), (i + q) % 3 == 0, i)
            for q in range(10) for i in range(12)]
    df = spark.createDataFrame(rows, "qid long, domain string, before double, after double, r boolean, seq long")
    df = df.withColumn("rel", df.r.cast("int")).drop("r")
    rep = metrics.rerank_report(df, ["before", "after"]).collect()
    assert len(rep) == 12
    assert {r.metric for r in rep} == {"map", "mrr@10", "ndcg@10"}


@pytest.mark.parametrize("range_levels", [1, 3, 1024])
def test_split_method_against_brute_force_with_hot_query(spark, range_levels):
    rng = random.Random(5)
    rows, expect = [], {}
    groups = {q: [(float(rng.randint(0, 4)), rng.randint(0, 1), i) for i in range(rng.randint(1, 25))]
              for q in range(40)}
    # one query carries about a third of all rows, with many distinct scores and ties
    groups[999] = [(float(rng.randint(0, 300)) / 7, rng.randint(0, 1), i) for i in range(300)]
    for q, cands in groups.items():
        rows += [(q, s, r, i) for s, r, i in cands]
        expect[q] = brute(cands)
    df = spark.createDataFrame(rows, "qid long, score double, rel int, seq long").repartition(6)
    got = metrics.per_query_metrics(df, ["qid"], empty_side="zero", method="split", range_levels=range_levels).collect()
    assert len(got) == len(groups)
    for r in got:
        ap, rr, nd = expect[r.qid]
        assert r.ap == pytest.approx(ap or 0.0, abs=1e-9)
        assert r.rr == pytest.approx(rr, abs=1e-9)
        assert r.ndcg == pytest.approx(nd or 0.0, abs=1e-9)


def test_split_equals_window_on_fixture(spark):
    from conftest import SF_SMALL
    from distillery.sources import fixtures as fx
    p = fx.judged_vector_pairs(spark, SF_SMALL)
    a = {(r.domain, r.model, r.metric): r.value for r in metrics.rerank_report(p, ["before", "after"]).collect()}
    b = {(r.domain, r.model, r.metric): r.value
         for r in metrics.rerank_report(p, ["before", "after"], method="split").collect()}
    assert a.keys() == b.keys()
    for key in a:
        assert a[key] == pytest.approx(b[key], abs=1e-12)


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_metrics_partition_invariance(spark, parts):
    rng = random.Random(9)
    rows = [(q, float(rng.randint(0, 3)), rng.randint(0, 1), i) for q in range(30) for i in range(rng.randint(1, 15))]
    df = spark.createDataFrame(rows, "qid long, score double, rel int, seq long")
    ref = {r.qid: (r.ap, r.rr, r.ndcg) for r in metrics.per_query_metrics(df.coalesce(1), ["qid"], empty_side="zero").collect()}
    got = {r.qid: (r.ap, r.rr, r.ndcg) for r in metrics.per_query_metrics(df.repartition(parts), ["qid"], empty_side="zero").collect()}
    assert got.keys() == ref.keys()
    for q in ref:
        assert got[q] == pytest.approx(ref[q], abs=1e-12)


def test_metrics_plan_one_exchange_one_sort(spark):
    rows = [(q, float(i % 3), i % 2, i) for q in range(5) for i in range(6)]
    df = spark.createDataFrame(rows, "qid long, score double, rel int, seq long").repartition(3)
    pq = metrics.per_query_metrics(df, ["qid"], empty_side="zero")
    text = pq._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(qid") == 1, text
    assert text.count("Sort [qid") == 1, text  # all four window functions share one sort


@pytest.mark.parametrize("method", ["window", "split"])
def test_null_and_nan_scores_take_no_part(spark, method):
    clean = [(1, 0.9, 0, 0), (1, 0.5, 1, 1), (1, 0.1, 1, 2)]
    schema = "qid long, score double, rel int, seq long"
    bad = [(1, float("nan"), 1, 3), (1, None, 1, 4)]
    row = lambda rows: metrics.per_query_metrics(
        spark.createDataFrame(rows, schema), ["qid"], method=method).first().asDict()
    assert row(clean + bad) == pytest.approx(row(clean))
