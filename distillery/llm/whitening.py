"""Whitening of embeddings by an incremental eigendecomposition.

The vectors, on a grid of 1/64, are whole numbers; each distinct one counts once. A task
takes its vectors one by one into the eigendecomposition of their scatter: adding a vector
is a centred rank-one update, whose eigenvalues are the roots of a secular equation and
whose eigenvectors follow from them; directions that the update doesn't touch, and equal
eigenvalues, are deflated. Two tasks' spectra are combined by successive rank-one updates,
one for each direction of the smaller one and one for the difference of the means, in
rounds of a fixed fan-in. The basis so found is refined by a distributed Rayleigh-Ritz step:
the exact integers n*x - S are projected on it and their covariance gathered, and the small
projected problem (its side is the number of dimensions) is solved.

What leaves a task is a few matrices of dimension x dimension; the rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from distillery.llm.common import stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Vectors that a task takes into one spectrum, and spectra that are combined at once.
TASK_ROWS, FAN_IN = 1 << 16, 16
#: Spectra that a task keeps side by side, to be combined at its end.
STREAMS = 8
#: Eigenvalues below this share of the largest are no components: their direction is rounding.
RANK_TOLERANCE = 1e-10
#: Grid values are held to this size, so that sums of squares stay within whole numbers.
GRID_BOUND = 1 << 40
EPS = np.finfo(float).eps
#: A root is found when the secular function is this small against its terms; what is left
#: over is far below what the Rayleigh-Ritz step mends.
SECULAR_TOLERANCE = 1e-9


# ---- rank-one updates -------------------------------------------------------------------

def secular_roots(d: np.ndarray, z2: np.ndarray, rho: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row: the roots of 1 + rho * sum(z2 / (d - x)) for ascending, distinct ``d``, positive
    ``z2`` (adding up to 1) and positive ``rho``: each as the index of the nearest pole and the
    offset from it, which keeps their differences to the poles exact. All rows' roots are found
    together."""
    m, k = d.shape
    upper = np.concatenate([d[:, 1:], d[:, -1:] + rho[:, None]], axis=1)
    width = (upper - d).ravel()
    own = np.tile(np.arange(k), m)
    stream = np.repeat(np.arange(m), k)
    poles, weight = d[stream], (rho[:, None] * z2)[stream]
    middle = d.ravel() + width / 2
    f = 1 + (weight / (poles - middle[:, None])).sum(axis=1)
    right = np.minimum(own + 1, k - 1)
    origin = np.where(f >= 0, own, right)
    delta = poles - d[stream, origin][:, None]  # poles as seen from each root's origin
    low, high = np.where(f >= 0, 0.0, -width / 2), np.where(f >= 0, width / 2, 0.0)
    beyond = (own == k - 1) & (f < 0)  # the last interval's upper end is no pole
    low[beyond], high[beyond] = width[beyond] / 2, width[beyond]
    t = (low + high) / 2
    below = (np.arange(k)[None, :] <= np.arange(k)[:, None]).astype(float)
    roots = np.arange(m * k)  # those not found yet
    for _ in range(80):
        gap = delta[roots] - t[roots, None]
        gap[gap == 0] = EPS * EPS
        term = weight[roots] / gap
        slope = term / gap
        some = below[own[roots]]
        psi, dpsi = np.einsum("ij,ij->i", term, some), np.einsum("ij,ij->i", slope, some)
        phi, dphi = term.sum(axis=1) - psi, slope.sum(axis=1) - dpsi
        value = 1 + psi + phi
        lo, hi = np.where(value < 0, t[roots], low[roots]), np.where(value < 0, high[roots], t[roots])
        low[roots], high[roots] = lo, hi
        open_ = (np.abs(value) > SECULAR_TOLERANCE * (1 + np.abs(psi) + np.abs(phi))) & (
            hi - lo > 2 * EPS * np.maximum(np.abs(lo), np.abs(hi)))
        if not open_.any():
            break
        # both sides are replaced by one pole each that has their value and slope here
        n = np.arange(len(roots))
        g1, g2 = gap[n, own[roots]], gap[n, right[roots]]
        with np.errstate(all="ignore"):
            c = value - g1 * dpsi - g2 * dphi
            a = (g1 + g2) * value - g1 * g2 * (dpsi + dphi)
            b = g1 * g2 * value
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step = np.where(own[roots] == k - 1, g1 * value / (value - g1 * dpsi), step)  # one pole only
            new = t[roots] + step
        new = np.where(np.isfinite(new) & (new > lo) & (new < hi), new, (lo + hi) / 2)
        t[roots[open_]] = new[open_]
        roots = roots[open_]
    return origin.reshape(m, k), t.reshape(m, k)


def _turned(d: np.ndarray, z: np.ndarray, rho: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row: eigenvalues and eigenvectors (columns) of diag(d) + rho z z', where ``d`` ascends
    without equals and no entry of ``z`` is next to nothing."""
    m, k = d.shape
    norm2 = (z * z).sum(axis=1)
    origin, t = secular_roots(d, z * z / norm2[:, None], rho * norm2)
    at = np.take_along_axis(d, origin, axis=1)
    over = (at[:, None, :] - d[:, :, None]) + t[:, None, :]  # root j minus pole i
    order = np.arange(k)
    # the vector for which these roots are exact: eigenvectors then are orthogonal
    with np.errstate(divide="ignore", invalid="ignore"):
        poles = d[:, None, :] - d[:, :, None]
        under = np.empty((m, k, k))
        under[:, :, :k - 1] = poles[:, order[:, None], order[None, :k - 1] + (order[None, :k - 1] >= order[:, None])]
        under[:, :, k - 1] = (rho * norm2)[:, None]
        zhat = np.sqrt(np.abs(np.prod(over / under, axis=2))) * np.where(z < 0, -1.0, 1.0)
        u = zhat[:, :, None] / -over
    u = np.where(np.isfinite(u), u, 0.0)
    size = np.sqrt((u * u).sum(axis=1))
    for row, column in zip(*np.nonzero(~(size > 0))):
        u[row, :, column], size[row, column] = np.eye(k)[:, column], 1.0
    return at + t, u / size[:, None, :]


def _least(d: np.ndarray, rho: np.ndarray | float) -> np.ndarray | float:
    """What counts as nothing: differences and entries below are deflated."""
    return 8 * EPS * np.maximum(np.abs(d).max(axis=-1), rho)


def rank_one(d: np.ndarray, q: np.ndarray, v: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors (columns) of q diag(d) q' + weight * v v'."""
    z = q.T @ v
    norm2 = float(z @ z)
    rho = weight * norm2
    if not rho > 0:
        return d, q
    z = z / np.sqrt(norm2)
    least = _least(d, rho)
    # deflation: an equal pair is turned so that one of the two is not touched
    close = np.flatnonzero(np.diff(d) <= least) if len(d) > 1 else ()
    if len(close):
        q = q.copy()
        for i in close:
            r = np.hypot(z[i], z[i + 1])
            if r > 0:
                c, s = z[i + 1] / r, z[i] / r
                a, b = q[:, i].copy(), q[:, i + 1].copy()
                q[:, i], q[:, i + 1] = c * a - s * b, s * a + c * b
                z[i], z[i + 1] = 0.0, r
    active = np.flatnonzero(rho * np.abs(z) > least)
    if len(active) == 0:
        return d, q
    da = np.maximum.accumulate(d[active] + np.arange(len(active)) * EPS * EPS)
    values, turn = _turned(da[None], z[active][None], np.array([rho]))
    new_d, new_q = d.copy(), q.copy()
    new_d[active], new_q[:, active] = values[0], q[:, active] @ turn[0]
    by = np.argsort(new_d, kind="stable")
    return new_d[by], new_q[:, by]


def rank_one_each(d: np.ndarray, q: np.ndarray, v: np.ndarray, weight: float) -> None:
    """:func:`rank_one` of several decompositions at once, in place; those that need deflation go
    one by one."""
    z = np.einsum("bij,bi->bj", q, v)
    norm2 = (z * z).sum(axis=1)
    rho = weight * norm2
    least = _least(d, rho)
    plain = (rho > 0) & (rho[:, None] * np.abs(z) > least[:, None] * np.sqrt(norm2)[:, None]).all(axis=1)
    if d.shape[1] > 1:
        plain &= (np.diff(d, axis=1) > least[:, None]).all(axis=1)
    for i in np.flatnonzero(~plain):
        d[i], q[i] = rank_one(d[i], q[i], v[i], weight)
    some = np.flatnonzero(plain)
    if len(some):
        values, turn = _turned(d[some], z[some] / np.sqrt(norm2[some])[:, None], rho[some])
        by = np.argsort(values, axis=1, kind="stable")
        d[some] = np.take_along_axis(values, by, axis=1)
        q[some] = np.matmul(q[some], np.take_along_axis(turn, by[:, None, :], axis=2))


class Spectrum:
    """Number, mean and eigendecomposition of the scatter of the vectors taken so far."""

    def __init__(self, size: int):
        self.n, self.mean, self.d, self.q = 0, np.zeros(size), np.zeros(size), np.eye(size)

    def add(self, x: np.ndarray) -> None:
        away = x - self.mean
        if self.n:
            self.d, self.q = rank_one(self.d, self.q, away, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + away / self.n

    def combine(self, other: Spectrum) -> None:
        if other.n == 0:
            return
        if self.n == 0:
            self.n, self.mean, self.d, self.q = other.n, other.mean, other.d, other.q
            return
        for value, vector in zip(other.d, other.q.T):
            if value > 0:
                self.d, self.q = rank_one(self.d, self.q, vector, value)
        away = other.mean - self.mean
        both = self.n + other.n
        self.d, self.q = rank_one(self.d, self.q, away, self.n * other.n / both)
        self.mean = self.mean + away * (other.n / both)
        self.n = both

    def flat(self) -> np.ndarray:
        return np.concatenate([[self.n], self.mean, self.d, self.q.ravel()])

    @staticmethod
    def of(flat: np.ndarray, size: int) -> Spectrum:
        out = Spectrum(size)
        out.n, out.mean, out.d = int(flat[0]), flat[1:size + 1], flat[size + 1:2 * size + 1]
        out.q = flat[2 * size + 1:].reshape(size, size)
        return out


class Streams:
    """Several spectra that take vectors in turn, so that their updates are worked out together."""

    def __init__(self, size: int, number: int):
        self.n, self.mean = 0, np.zeros((number, size))
        self.d, self.q = np.zeros((number, size)), np.tile(np.eye(size), (number, 1, 1))

    def add(self, rows: np.ndarray) -> None:
        """One vector for each spectrum."""
        away = rows - self.mean
        if self.n:
            rank_one_each(self.d, self.q, away, self.n / (self.n + 1))
        self.n += 1
        self.mean += away / self.n

    def combined(self) -> Spectrum:
        out = Spectrum(self.d.shape[1])
        for mean, d, q in zip(self.mean, self.d, self.q):
            other = Spectrum(len(d))
            other.n, other.mean, other.d, other.q = self.n, mean, d, q
            out.combine(other)
        return out


# ---- rounds over tasks -------------------------------------------------------------------

PART = "part long, wholes array<long>, reals array<double>"


def _gathered(rows: DataFrame, first: Callable, merge: Callable, fan_in: int) -> tuple[np.ndarray, np.ndarray] | None:
    """``first`` makes ``(whole numbers, reals)`` of each task's vectors, ``merge`` one of several; they are merged
    in rounds, ``fan_in`` at a time in a fixed order, until one is left. None without a row."""
    from pyspark import TaskContext

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = first(x for x in map(_matrix, batches) if len(x))
        if got is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([got[0]], pa.list_(pa.int64())),
                 pa.array([got[1]], pa.list_(pa.float64()))], ["part", "wholes", "reals"])

    def together(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        whole, real = merge(list(zip(pdf.wholes, pdf.reals)))
        return pd.DataFrame({"part": [int(pdf.part.iloc[0]) // fan_in], "wholes": [whole], "reals": [real]})

    parts = stored(rows.mapInArrow(begin, PART))
    n = parts.agg(F.coalesce(F.max("part") + 1, F.lit(0))).first()[0]
    while n > 1:
        group = F.floor(F.col("part") / fan_in)
        parts = stored(parts.groupBy(group.alias("g")).applyInPandas(together, PART))
        n = -(-n // fan_in)
    left = parts.collect()  # one row: a matrix or two
    return (np.array(left[0].wholes, np.int64), np.array(left[0].reals)) if left else None


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column(batch.schema.get_field_index("x"))
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)


def grid(vector: Column) -> Column:
    """floor(64 * entry) + 1,000,000 of each entry, as long."""
    bound = F.lit(float(GRID_BOUND))
    return F.transform(vector, lambda c: F.greatest(-bound, F.least(bound, F.floor(c.cast("double") * SCALE).cast("double")))
                       .cast("long") + SHIFT)


def sound(vector: Column) -> Column:
    """True if the vector and all its entries are there and finite."""
    fine = F.forall(vector, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))),
                                                 F.lit(False)))
    return F.coalesce(fine & (F.size(vector) > 0), F.lit(False))


class Whitening:
    """A fitted transform: exact sums, components by falling eigenvalue, and how well it whitens."""

    def __init__(self, n: int, sums: np.ndarray, values: np.ndarray, vectors: np.ndarray, trace: float):
        self.n, self.sums, self.values, self.vectors, self.trace = n, sums, values, vectors, trace
        self.identity_error = 0.0
        self.explained = values / trace if trace > 0 else values

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n to double precision: n*x - S is a whole number."""
        return (self.n * x - self.sums) / float(self.n)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


def fit(vectors: DataFrame, column: str = "x", components: int = COMPONENTS, task_rows: int = TASK_ROWS,
        fan_in: int = FAN_IN) -> Whitening | None:
    """Fit to each distinct array<long> of ``column`` once. None if there is none, or no two."""
    spark = vectors.sparkSession
    distinct = stored(vectors.select(F.col(column).alias("x")).groupBy("x").agg(F.lit(1).alias("one")).select("x"))
    n = distinct.count()
    if n == 0:
        return None
    # rows are dealt by a hash of the vector: tasks of a bounded number of vectors, on all cores
    tasks = max(-(-n // task_rows), min(spark.sparkContext.defaultParallelism, -(-n // 64)))
    dealt = stored(distinct.repartition(tasks, "x"))
    size = dealt.select(F.size("x")).first()[0]

    def scatter(matrices: Iterator[np.ndarray]):
        streams, rest, sums, held = Streams(size, STREAMS), Spectrum(size), np.zeros(size, np.int64), []
        for m in matrices:
            sums += m.sum(axis=0)
            held = np.concatenate([held, m.astype(float)]) if len(held) else m.astype(float)
            whole = len(held) // STREAMS * STREAMS
            for i in range(0, whole, STREAMS):
                streams.add(held[i:i + STREAMS])
            held = held[whole:]
        for row in held:  # fewer than there are streams
            rest.add(row)
        spectrum = streams.combined()
        spectrum.combine(rest)
        return (sums, spectrum.flat()) if spectrum.n else None

    def combined(parts: list):
        whole, spectrum = np.zeros(size, np.int64), Spectrum(size)
        for sums, flat in parts:
            whole += sums
            spectrum.combine(Spectrum.of(np.array(flat), size))
        return whole, spectrum.flat()

    sums, flat = _gathered(dealt, scatter, combined, fan_in)
    basis, _ = np.linalg.qr(Spectrum.of(flat, size).q[:, ::-1])
    fitted = Whitening(n, sums, np.zeros(size), basis, 0.0)

    def products(project: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
        def begin(matrices: Iterator[np.ndarray]):
            out = None
            for m in matrices:
                y = project(m)
                out = y.T @ y if out is None else out + y.T @ y
            return None if out is None else (np.zeros(0, np.int64), out.ravel())

        def add(parts: list):
            return np.zeros(0, np.int64), np.sum([np.array(x[1]) for x in parts], axis=0)

        return _gathered(dealt, begin, add, fan_in)[1].reshape(width, width) / n

    # Rayleigh-Ritz: the covariance on the basis, whose small eigenproblem turns the basis
    ritz = products(lambda x: fitted.centred(x) @ basis, size)
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    kept = min(components, int((values > RANK_TOLERANCE * max(values[0], 0.0)).sum())) if values[0] > 0 else 0
    out = Whitening(n, sums, values[:kept], (basis @ turn)[:, :kept], float(np.trace(ritz)))
    if kept:
        mean = _mean(dealt, out, fan_in, n)
        error = products(lambda x: out(x) - mean, kept) - np.eye(kept)
        out.identity_error = float(np.abs(error).max())
    return out


def _mean(rows: DataFrame, fitted: Whitening, fan_in: int, n: int) -> np.ndarray:
    def begin(matrices: Iterator[np.ndarray]):
        total = sum((fitted(m).sum(axis=0) for m in matrices), np.zeros(len(fitted.values)))
        return np.zeros(0, np.int64), total

    def add(parts: list):
        return np.zeros(0, np.int64), np.sum([np.array(x[1]) for x in parts], axis=0)

    return _gathered(rows, begin, add, fan_in)[1] / n


def deviations(fitted: Whitening, x: np.ndarray) -> list[int | None]:
    """The exact sum over dimensions of (n*x - S)^2; None beyond a long."""
    away = fitted.n * x - fitted.sums
    if len(away) and float(np.abs(away).max()) ** 2 * away.shape[1] < 2 ** 62:
        return (away * away).sum(axis=1).tolist()
    exact = [sum(int(a) * int(a) for a in row) for row in away]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error``: a row for each row
    with a sound vector and each component.

    Rows whose vector is null, empty or holds a null or non-finite entry are left out, as are
    those whose length isn't the commonest one (ties: the longer); the others come back however
    often they repeat, null keys too, and count once in the fit. Entries beyond ``GRID_BOUND``
    grid steps are held there. There are fewer components than asked for if the vectors have
    fewer dimensions or lie in fewer directions, none for fewer than two distinct vectors. A
    deviation that a long can't hold is null. Other columns aren't read. An empty table gives
    an empty result.
    """
    kind = rows.schema[key].dataType.simpleString()
    schema = f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    good = rows.select(F.col(key).alias("key"), F.col(vector).alias("v")).filter(sound(F.col("v")))
    good = stored(good.select("key", grid(F.col("v")).alias("x")))
    sizes = good.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if sizes is not None:
        good = good.filter(F.size("x") == sizes[0])
    fitted = fit(good, "x", components)
    if fitted is None or not len(fitted.values):
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fitted.values)
        for whole in batches:
            for start in range(0, len(whole), 4096):
                batch = whole.slice(start, 4096)
                m = _matrix(batch)
                w = fitted(m)
                spots = pa.array(np.repeat(np.arange(len(batch)), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(spots), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(batch))),
                     pa.array(np.full(len(spots), fitted.n)), pa.array(deviations(fitted, m), pa.int64()).take(spots),
                     pa.array(w.ravel()), pa.array(np.tile(fitted.explained, len(batch))),
                     pa.array(np.full(len(spots), fitted.identity_error))],
                    ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return good.mapInArrow(transform, schema).withColumnRenamed("key", key)
