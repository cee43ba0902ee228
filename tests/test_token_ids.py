"""Token ids in Python helpers: results, and that no id is turned by an interpreted expression."""

import hashlib

from distillery.functions import text as tf
from distillery.plans import catalog


def test_ids_and_digests_of_any_text(spark):
    texts = ["", None, "dé", "\U0001f600x", "\x00", *["ab" * i for i in range(2 * tf.ID_ROWS)]]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string").coalesce(1)
    rows = df.withColumn("ids", tf.char_token_ids("t")).withColumn("md5", tf.ids_md5("ids")).orderBy("n").collect()
    assert [r.ids for r in rows] == [[ord(c) for c in t or ""] for t in texts]
    assert [r.md5 for r in rows] == [hashlib.md5(",".join(map(str, r.ids)).encode()).hexdigest() for r in rows]
    assert [r[0] for r in spark.sql("SELECT CAST(NULL AS array<int>) AS ids").select(tf.ids_md5("ids")).collect()] == [None]


def test_prompt_ids_are_not_turned_one_by_one_in_the_plan(spark, tmp_path):
    spark.createDataFrame([(1, "a" * 9000), (2, "b")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = catalog.truncate_suffix(spark, str(tmp_path))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "ascii(" not in plan
    r, = df.collect()
    n = tf.DEFAULT_MAX_TOKENS + len(tf.ASSISTANT_SUFFIX)
    assert (r.n_ids, r.tail_ids) == (n, ",".join(str(ord(c)) for c in tf.ASSISTANT_SUFFIX[-4:]))
