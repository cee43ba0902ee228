"""Before/after comparison on the published numbers plus a zero-base row."""

import math

import pytest

from distillery.operators import report

# fixed values: the nine published before/after rows (golden input), plus before = 0
GOLDEN = [
    ("reranker", "map", 0.472061, 0.565317),
    ("reranker", "mrr@10", 0.478234, 0.573779),
    ("reranker", "ndcg@10", 0.547284, 0.639033),
    ("in", "map", 0.7744, 0.8534),
    ("in", "mrr@10", 0.9321, 0.9554),
    ("in", "ndcg@10", 0.8296, 0.8973),
    ("out", "map", 0.5168, 0.5040),
    ("out", "mrr@10", 0.5240, 0.5116),
    ("out", "ndcg@10", 0.5904, 0.5774),
    ("zero", "map", 0.0, 0.25),
]


def metrics_df(spark):
    rows = []
    for d, m, b, a in GOLDEN:
        rows += [(d, "before", m, b), (d, "after", m, a)]
    return spark.createDataFrame(rows, "domain string, model string, metric string, value double")


@pytest.mark.parametrize("zero_base,expect", [("inf", math.inf), ("zero", 0.0)])
def test_compare_runs(spark, zero_base, expect):
    got = {(r.domain, r.metric): r for r in report.compare_runs(metrics_df(spark), zero_base=zero_base).collect()}
    r = got[("reranker", "map")]
    assert r.abs_change == pytest.approx(0.093256, abs=1e-9)
    assert r.rel_change == pytest.approx(19.755, abs=1e-3)
    assert r.direction == "↑"
    assert got[("out", "map")].direction == "↓"
    assert got[("in", "ndcg@10")].rel_change == pytest.approx(8.161, abs=1e-3)
    assert got[("zero", "map")].rel_change == expect


def test_format_styles(spark):
    cmp = report.compare_runs(metrics_df(spark), zero_base="inf")
    rr = {(r.domain, r.metric): r for r in report.format_report(cmp, "reranker").collect()}
    r = rr[("reranker", "mrr@10")]
    assert (r.metric_label, r.before_text, r.abs_text, r.rel_text) == ("MRR@10", "0.478234", "+0.095545", "+19.98%")
    assert rr[("zero", "map")].rel_text == "+inf%"
    emb = {(r.domain, r.metric): r for r in report.format_report(cmp, "embedding").collect()}
    e = emb[("out", "map")]
    assert (e.before_text, e.after_text, e.abs_text, e.rel_text) == ("0.5168", "0.5040", "-0.0128", "-2.48")


def test_missing_after_raises(spark):
    df = spark.createDataFrame([("d", "before", "map", 0.5)], "domain string, model string, metric string, value double")
    with pytest.raises(Exception):
        report.compare_runs(df).collect()
