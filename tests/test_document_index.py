"""The document index: texts stay in the scan, copies share a key and a vector."""

from distillery.sources import fixtures as fx


def test_texts_are_not_shuffled_and_copies_share_a_vector(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (3, "a")], "doc_id long, text string")
    emb = spark.createDataFrame([(3, [3.0]), (1, [1.0]), (5, None), (4, [4.0])], "vec_id long, embedding array<float>")
    index = fx.index_documents(docs, emb)
    got = sorted((r.doc_id, r.text_key, r.n_chars, r.vec_id, r.embedding) for r in index.collect())
    assert got == [(1, 1, 1, 1, [1.0]), (2, 2, 1, None, None), (3, 1, 1, 1, [1.0]), (3, 1, 1, 1, [1.0]), (5, 5, 0, 5, None)]

    def moved(plan):
        found = [plan.output().mkString(",")] if "Exchange" in plan.nodeName() else []
        children = plan.children()
        return found + [x for i in range(children.size()) for x in moved(children.apply(i))]

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        columns = moved(fx.index_documents(docs, emb)._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert columns and not [x for x in columns if "text#" in x]
