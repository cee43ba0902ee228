"""Every registered query against its DuckDB oracle on the small scale, plus the
driver contract (entry smoke, keys)."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as E
from distillery.plans.catalog import QUERIES
from distillery.plans.oracle import ORACLES

from conftest import SF_SMALL

TABLES = ("documents embeddings conversations labels benchmark pages events").split()


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        return f"{v:.6f}" if isinstance(v, float) else repr(v)

    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(q) and set(ORACLES) <= set(o)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["qid", "positive", "negative", "pos_rank", "neg_rank", "score"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(drows)
    assert _digest(df.columns, rows) == _digest(rel.columns, drows)


@pytest.mark.parametrize("name", ["hard_negative_triplets", "rerank_report", "document_hard_negatives"])
def test_results_independent_of_physical_strategy(spark, name):
    """Same rows with AQE off, broadcast joins disabled and an odd shuffle partition count."""
    ref = sorted(map(repr, E.queries()[name](spark, SF_SMALL).collect()))
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "13"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = sorted(map(repr, E.queries()[name](spark, SF_SMALL).collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == ref
