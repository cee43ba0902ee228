"""Both sides of every scoring group are bounded; nothing is lost or scored twice by the cuts."""

import numpy as np
from pyspark.sql import functions as F

from distillery.llm import prefix_forest as pf


def test_both_sides_of_every_group_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(pf, "CHUNK_ROWS", 100)
    monkeypatch.setattr(pf, "BLOCK_QUERIES", 40)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.standard_normal(4)]) for i in range(600)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    nodes = vectors.select(F.col("vec_id").alias("node"), F.col("embedding").alias("vector"), F.lit(True).alias("is_query"),
                            F.col("vec_id").alias("least"))
    data = pf.stored(pf._hashed(nodes, 4, 2, 5.0))
    runs, asked = pf._dealt(data, data, 0, 1)
    for side, bound in ((runs, 100), (asked, 40)):
        sizes = [r["count"] for r in side.groupBy(*pf.GROUP).count().collect()]
        assert len(sizes) == 6 * 15 and max(sizes) <= 2 * bound
    assert runs.count() == 600 * 15 and asked.count() == 600 * 6
    got = {(r.query_id, r["rank"]): r.vec_id for r in pf.nearest(vectors, F.col("vec_id") % 2 == 0, 5, trees=4, target=0.999999).collect()}
    x = np.array([v for _, v in rows])
    scores = x @ x.T
    np.fill_diagonal(scores, -np.inf)
    want = np.argsort(-scores[::2], axis=1)[:, :5]
    found = np.array([[got[q, r] for r in range(1, 6)] for q in range(0, 600, 2)])
    assert (found == want).mean() > 0.98
