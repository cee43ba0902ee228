"""Whitening against a dense eigendecomposition, and rank-one updates against theirs."""

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
from conftest import spark  # noqa: E402, F401

from distillery.llm import whitening as w  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>"


def sets():
    rng = np.random.default_rng(2)
    yield rng.normal(size=(200, 12)) * 64
    yield np.floor(rng.normal(size=(120, 6)))  # many equal entries
    yield np.ones((30, 4))
    yield np.eye(5)[rng.integers(0, 5, 80)] * 64  # equal eigenvalues
    yield rng.normal(size=(100, 2)) @ rng.normal(size=(2, 9))  # two directions
    yield rng.normal(size=(60, 8)) * 10.0 ** np.arange(-4, 4)
    yield rng.normal(size=(20, 1))
    yield np.zeros((3, 3))


@pytest.mark.parametrize("x", list(sets()), ids=range(8))
def test_incremental_spectra(x):
    size = x.shape[1]
    one, a, b = (w.Spectrum(size) for _ in range(3))
    for i, row in enumerate(x):
        one.add(row)
        (a if i % 3 else b).add(row)
    a.combine(b)
    a.combine(w.Spectrum(size))
    streams = w.Streams(size, 3)
    for i in range(0, len(x) - 2, 3):
        streams.add(x[i:i + 3])
    several = streams.combined()
    for row in x[len(x) // 3 * 3:]:
        several.add(row)
    centred = x - x.mean(axis=0)
    scatter = centred.T @ centred
    scale = max(1.0, np.abs(scatter).max())
    for s in (one, a, several, w.Spectrum.of(a.flat(), size)):
        assert s.n == len(x) and np.allclose(s.mean, x.mean(axis=0), atol=1e-9 * max(1, np.abs(x).max()))
        assert np.abs(s.q.T @ s.q - np.eye(size)).max() < 1e-12
        assert np.abs(s.q @ np.diag(s.d) @ s.q.T - scatter).max() < 1e-8 * scale


def test_secular_roots_interlace():
    rng = np.random.default_rng(5)
    for k in (1, 2, 3, 40):
        d = np.sort(rng.uniform(0, 100, k))
        z = rng.normal(size=k)
        z /= np.linalg.norm(z)
        origin, t = (x[0] for x in w.secular_roots(d[None], (z * z)[None], np.array([7.0])))
        got = d[origin] + t
        assert (got >= d).all() and (got[:-1] <= d[1:]).all() and got[-1] <= d[-1] + 7.0 + 1e-9
        assert np.allclose(got, np.linalg.eigvalsh(np.diag(d) + 7.0 * np.outer(z, z)), atol=1e-6)


def dense(vectors):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = (n * fit - s) / n
    e, q = np.linalg.eigh(c.T @ c / n)
    return x, n, s, e[::-1], q[:, ::-1]


def test_whitening_against_dense(spark):  # noqa: F811
    rng = np.random.default_rng(7)
    base = (rng.normal(size=(300, 20)) * np.linspace(1, 3, 20)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(i + 1000, base[0].tolist()) for i in range(150)] + [(None, base[1].tolist()), (3, base[3].tolist())]
    bad = [(5000, None), (5001, []), (5002, [None] * 20), (5003, [float("nan")] * 20), (5004, [float("inf")] + [0.0] * 19), (5005, [1.0] * 3)]
    df = spark.createDataFrame(rows + bad, SCHEMA).withColumn("x", w.F.lit("clash")).withColumn("part", w.F.lit(1))
    got = w.whiten(df.repartition(5)).collect()
    x, n, s, e, q = dense([v for _, v in rows])
    assert len(got) == 16 * len(rows) and {r.n for r in got} == {n} == {300}
    assert max(r.identity_error for r in got) < 1e-9
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    signs = None
    for (key, v), row in zip(rows, x):
        dev = int(((n * row - s) ** 2).sum())
        mine = by[(key, dev)]
        white = ((n * row - s) / n) @ q[:, :16] / np.sqrt(e[:16])
        have = np.array([mine[c].whitened for c in range(1, 17)])
        if signs is None and np.abs(white).min() > 1e-3:
            signs = np.sign(have * white)
        if signs is not None:
            assert np.allclose(have, signs * white, atol=1e-8)
        assert np.allclose([mine[c].explained for c in range(1, 17)], e[:16] / e.sum(), rtol=1e-9)


def test_few_directions_and_empty(spark):  # noqa: F811
    rows = [(i, [float(i % 7), 2.0 * (i % 7), 5.0]) for i in range(50)]
    got = w.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component for r in got} == {1} and len(got) == 50 and got[0].explained == pytest.approx(1.0)
    assert w.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).collect() == []
    empty = w.whiten(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns[0] == "vec_id"


def test_many_tasks_are_combined_in_rounds(spark):  # noqa: F811
    rng = np.random.default_rng(9)
    v = rng.normal(size=(700, 6)).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], SCHEMA)
    fitted = w.fit(df.select(w.grid(w.F.col("embedding")).alias("x")), "x", 4, task_rows=50, fan_in=3)
    _, n, s, e, q = dense(v)
    assert fitted.n == n and (fitted.sums == s).all() and np.allclose(fitted.values, e[:4], rtol=1e-10)
    assert np.allclose(np.abs((fitted.vectors * q[:, :4]).sum(axis=0)), 1, atol=1e-10)


def test_deviation_beyond_a_long():
    f = w.Whitening(10 ** 9, np.array([0]), np.ones(1), np.ones((1, 1)), 1.0)
    assert w.deviations(f, np.array([[3], [4_000_000]])) == [9 * 10 ** 18, None]
