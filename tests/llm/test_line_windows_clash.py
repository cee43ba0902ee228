"""Line deduplication of documents with columns of the operator's own names."""

import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parents[1]))
from conftest import spark  # noqa: E402, F401

from distillery.llm.line_windows import dedup_lines  # noqa: E402


def test_clashing_columns_stay(spark):  # noqa: F811
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc"), (None, None), (3, "z\n" * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    names = ["n_lines", "n_removed", "x_own", "x_key", "x_covered", "x_digest", "key", "digest", "line", "at", "c0", "n_lines_"]
    for i, c in enumerate(names):
        docs = docs.withColumn(c, F.lit(100 + i))
    out = dedup_lines(docs)
    assert out.columns == [*docs.columns, "n_lines__", "n_removed_"]
    got = {r.doc_id: r for r in out.collect()}
    assert got[2].text == "x" and got[2]["n_removed_"] == 3 and got[2]["n_lines__"] == 4 and got[1].text == "a\nb\nc\nd"
    assert all(got[1][c] == 100 + i for i, c in enumerate(names))
    assert got[None].text is None and got[3]["n_lines__"] == 30_001 and got[3]["n_removed_"] > 29_000
