"""Column functions: cosine, log-prob teacher, truncation, prompt text, softmax / KL."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from distillery.functions import text as tf
from distillery.functions.numeric import fix6, fix9
from distillery.functions.scoring import kl_divergence_t, softmax_t, yes_no_logit
from distillery.functions.vectors import cosine, quantize


def test_cosine_and_zero_vector(spark):
    df = spark.createDataFrame([([1.0, 0.0, 2.0], [2.0, 1.0, 0.0]), ([0.0, 0.0, 0.0], [1.0, 2.0, 3.0])],
                               "a array<double>, b array<double>")
    got = [r.c for r in df.select(cosine("a", "b").alias("c")).collect()]
    assert got[0] == pytest.approx(2.0 / (math.sqrt(5) * math.sqrt(5)))
    assert got[1] == 0.0


def test_quantize_and_fix(spark):
    df = spark.createDataFrame([([0.149, -0.151, 0.25],)], "a array<double>")
    assert df.select(quantize("a", 1).alias("q")).first().q == [0.1, -0.2, 0.3]
    r = spark.range(1).select(fix9(F.lit(0.1234567894)).alias("a"), fix6(F.lit(-1.0000004)).alias("b")).first()
    assert r.a == 0.123456789 and r.b == -1.0


def test_yes_no_logit_floors(spark):
    df = spark.createDataFrame(
        [({"yes": -0.1, "no": -2.5},), ({"yes": -0.5},), ({"no": -0.3},), ({},)], "m map<string,double>")
    got = [r.x for r in df.select(yes_no_logit("m").alias("x")).collect()]
    assert got == pytest.approx([2.4, 9.5, -9.7, 0.0])


def test_truncate_with_suffix(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5],), ([],), ([7],)], "ids array<int>")
    got = [r.t for r in df.select(tf.truncate_with_suffix("ids", 3, [900, 901]).alias("t")).collect()]
    assert got == [[1, 2, 3, 900, 901], [900, 901], [7, 900, 901]]
    with pytest.raises(ValueError):
        tf.truncate_with_suffix("ids", 0, [1])


def test_char_token_ids_and_messages(spark):
    df = spark.createDataFrame([("q", "dé"), ("", "x")], "q string, d string")
    r = df.select(tf.char_token_ids("d").alias("ids"), tf.char_token_ids("q").alias("qi"),
                  tf.rerank_messages("q", "d").alias("m")).collect()
    assert r[0].ids == [100, 233] and r[1].qi == []
    m = r[0].m
    assert m[0].role == "system" and m[1].role == "user"
    assert m[1].content == f"<Instruct>: {tf.DEFAULT_INSTRUCTION}\n<Query>: q\n<Document>: dé"
    assert tf.suffix_token_ids()[:2] == [ord("<"), ord("|")]


def test_truthy_metric_name_and_paths(spark):
    df = spark.createDataFrame([("q", ["a"], ["b"]), ("", ["a"], ["b"]), ("q", [], ["b"]), ("q", ["a"], None)],
                               "q string, p array<string>, n array<string>")
    got = [r.t for r in df.select(tf.all_truthy(strings=["q"], arrays=["p", "n"]).alias("t")).collect()]
    assert got == [True, False, False, False]
    k = spark.createDataFrame([("test-evaluation_mrr@10",), ("map",)], "k string")
    assert [r.m for r in k.select(tf.metric_name("k").alias("m")).collect()] == ["mrr@10", "map"]
    p = spark.createDataFrame([("dir/train.jsonl",), ("dir/a.b/noext",), ("x.tar.gz",)], "p string")
    got = [r.o for r in p.select(tf.suffixed_path("p", "_s").alias("o")).collect()]
    assert got == ["dir/train_s.jsonl", "dir/a.b/noext_s", "x.tar_s.gz"]


def np_kl(t, s, T):
    def lsm(x):
        x = np.asarray(x) / T
        m = x.max()
        return x - m - np.log(np.exp(x - m).sum())
    lt, ls = lsm(t), lsm(s)
    return float((np.exp(lt) * (lt - ls)).sum() * T * T)


@pytest.mark.parametrize("T", [1.0, 2.0, 0.05])
def test_softmax_kl(spark, T):
    rows = [([0.8, 0.1], [0.3, 0.2]), ([500.0, -500.0], [-3.0, 4.0]), ([0.0, 0.0], [1.0, -1.0])]
    df = spark.createDataFrame(rows, "t array<double>, s array<double>")
    got = df.select(kl_divergence_t("t", "s", T).alias("kl"), softmax_t("t", T).alias("p")).collect()
    for (t, s), r in zip(rows, got):
        assert r.kl == pytest.approx(np_kl(t, s, T), rel=1e-9, abs=1e-12)
        assert sum(r.p) == pytest.approx(1.0)


@pytest.mark.parametrize("T", [1.0, 2.0])
def test_pair_kl_equals_array_kl(spark, T):
    from distillery.functions.scoring import kl_divergence_pair_t
    rows = [(0.8, 0.1, 0.3, 0.2), (500.0, -500.0, -3.0, 4.0), (0.0, 0.0, 1.0, -1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = df.select(kl_divergence_pair_t("a", "b", "c", "d", T).alias("x"),
                    kl_divergence_t(F.array("a", "b"), F.array("c", "d"), T).alias("y")).collect()
    for r in got:
        assert r.x == pytest.approx(r.y, rel=1e-12, abs=1e-15)
