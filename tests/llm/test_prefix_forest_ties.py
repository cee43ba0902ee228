"""Different vectors of equal score: the smaller keys are the neighbours, whatever the layout."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from distillery.llm import prefix_forest as pf


def test_ties_between_different_vectors(spark, monkeypatch):
    rows = [(i, [1.0, i % 20 / 10 - 1, i // 20 / 10 - 1]) for i in range(1, 401)] + [(0, [1.0, 0.0, 0.0]), (1000, [2.0, 0.0, 0.0])]
    random.Random(3).shuffle(rows)
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    for chunk in (8_192, 50):
        monkeypatch.setattr(pf, "CHUNK_ROWS", chunk)
        got = defaultdict(list)
        for r in sorted(pf.nearest(vectors, F.col("vec_id") % 1000 == 0, 5, target=0.9999999).collect()):
            got[r.query_id].append((r.vec_id, r.score))
        assert got == {0: [(1000, 2.0)] + [(i, 1.0) for i in range(1, 5)], 1000: [(i, 2.0) for i in range(5)]}
