"""JSONL readers (three modes), sinks and input order."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from distillery.sources import jsonl


def write_lines(path, lines, gz=False):
    opener = gzip.open if gz else open
    with opener(path, "wt", encoding="utf-8") as f:
        for line in lines:
            f.write(line + "\n")
    return str(path)


def test_strict_reader(spark, tmp_path):
    p = write_lines(tmp_path / "s.jsonl", [
        json.dumps({"query": "q1", "positive": ["a", None], "negative": ["b"]}),
        json.dumps({"query": "q2", "negative": ["c"]}),
        "",
        json.dumps({"query": "qé", "positive": ["ü"], "negative": []}, ensure_ascii=False),
    ])
    df = jsonl.read_samples(spark, [p], mode="strict")
    rows = {r.query: r for r in df.collect()}
    assert rows["q2"].positive == []
    assert rows["qé"].positive == ["ü"]
    bad = write_lines(tmp_path / "bad.jsonl", ['{"query": "x", "positive": ["a"]}', "{not json"])
    with pytest.raises(Exception):
        jsonl.read_samples(spark, [bad], mode="strict").collect()
    noq = write_lines(tmp_path / "noq.jsonl", ['{"positive": ["a"]}'])
    with pytest.raises(Exception):
        jsonl.read_samples(spark, [noq], mode="strict").collect()
    wrong = write_lines(tmp_path / "wrong.jsonl", ['{"query": "q", "positive": "not a list"}'])
    with pytest.raises(Exception):
        jsonl.read_samples(spark, [wrong], mode="strict").select("query").collect()


def test_truthy_reader(spark, tmp_path):
    p = write_lines(tmp_path / "t.jsonl", [
        json.dumps({"query": "q", "positive": ["a"], "negative": ["b"]}),
        json.dumps({"query": "", "positive": ["a"], "negative": ["b"]}),
        json.dumps({"query": "q", "positive": [], "negative": ["b"]}),
        json.dumps({"query": "q", "positive": ["a"]}),
    ])
    assert jsonl.read_samples(spark, [p], mode="truthy").count() == 1


def test_lenient_scored_pairs(spark, tmp_path):
    p = write_lines(tmp_path / "p.jsonl", [
        json.dumps({"query": "q", "passage": "a", "score": 1.5}),
        "{broken",
        json.dumps({"query": "q", "passage": "b"}),
        json.dumps({"query": "q", "passage": "c", "score": "1.5"}),
        '{"query": "q", "passage": "d", "score": NaN}',
        json.dumps({"query": "q", "passage": "e", "score": -2}),
    ])
    good, bad = jsonl.read_scored_pairs(spark, [p])
    assert sorted(r.passage for r in good.collect()) == ["a", "e"]
    assert bad.count() == 4


def test_missing_paths(spark, tmp_path):
    p = write_lines(tmp_path / "ok.jsonl", [json.dumps({"query": "q", "positive": ["a"], "negative": ["b"]})])
    df = jsonl.read_samples(spark, [p, str(tmp_path / "nope.jsonl")], mode="strict")
    assert df.count() == 1
    assert jsonl.read_samples(spark, [str(tmp_path / "nope.jsonl")]).count() == 0
    with pytest.raises(FileNotFoundError):
        jsonl.read_samples(spark, [str(tmp_path / "nope.jsonl")], on_missing="error")


def test_gzip_and_input_order_over_splits(spark, tmp_path):
    lines = [json.dumps({"query": "q", "passage": f"p{i:05d}", "score": 1.0}) for i in range(3000)]
    a = write_lines(tmp_path / "a.jsonl", lines)
    g = write_lines(tmp_path / "b.jsonl.gz", lines[:50], gz=True)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        good, _ = jsonl.read_scored_pairs(spark, [a, g], min_partitions=4)
        rows = good.where(F.col("source_file").endswith("a.jsonl")).orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.passage for r in rows] == [f"p{i:05d}" for i in range(3000)]
    assert good.where(F.col("source_file").endswith(".gz")).count() == 50


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("qé", "a", None, 1.0)] * 1200, "query string, positive string, negative string, score double")
    out = str(tmp_path / "out")
    jsonl.write_jsonl(df.limit(3), out)
    text = "".join(open(os.path.join(out, f), encoding="utf-8").read() for f in os.listdir(out) if f.endswith(".json"))
    assert '"qé"' in text and '"negative":null' in text
    shards = str(tmp_path / "shards")
    jsonl.write_training_shards(df.coalesce(1), shards, rows_per_shard=512)
    counts = sorted(sum(1 for _ in open(os.path.join(shards, f))) for f in os.listdir(shards) if f.endswith(".json"))
    assert counts == [176, 512, 512]
    t = jsonl.read_triplets(spark, shards, "margin")
    assert dict(t.dtypes)["score"] == "float"


def test_lenient_samples_and_soft_triplets(spark, tmp_path):
    p = write_lines(tmp_path / "s.jsonl", [
        json.dumps({"query": "q", "positive": ["a"], "negative": ["b"]}),
        "{broken",
        json.dumps({"positive": ["a"]}),
        json.dumps({"query": "q2", "positive": "not a list"}),
    ])
    good, bad = jsonl.read_samples(spark, [p], mode="lenient")
    assert [r.query for r in good.collect()] == ["q"]
    assert bad.count() == 3
    # a consumer that selects only the query still sees the same split
    assert good.select("query").count() == 1 and bad.select("query").count() == 3
    t = write_lines(tmp_path / "t.jsonl", [json.dumps({"query": "q", "positive": "a", "negative": "b",
                                                        "label": [0.25, 0.5]})])
    soft = jsonl.read_triplets(spark, t, "soft")
    assert dict(soft.dtypes)["label"] == "array<float>" and soft.first().label == [0.25, 0.5]
    with pytest.raises(ValueError):
        jsonl.read_triplets(spark, t, "other")
