"""Dense-vector math on ``array<double>`` columns with higher-order functions.

The expressions are written as Spark SQL text (``F.expr``): one round trip to build a
column instead of one per lambda node, and exactly the same JVM-side expression tree.
Arguments are column names (or SQL expressions). Vectors of one table must share a
length; ``zip_with`` pads a shorter array with NULL, which makes the dot product NULL
rather than silently wrong.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from distillery.functions.numeric import _c

# Norm floor: a zero vector has cosine 0 with anything (not NaN).
COSINE_EPS = 1e-8


def _sql(x) -> str:
    if isinstance(x, Column):
        raise TypeError("vector functions take column names or SQL expressions")
    return str(x)


def dot_sql(a, b) -> str:
    return f"aggregate(zip_with({_sql(a)}, {_sql(b)}, (x, y) -> x * y), 0D, (acc, x) -> acc + x)"


def to_double_array(col) -> Column:
    return _c(col).cast("array<double>")


def dot(a, b) -> Column:
    return F.expr(dot_sql(a, b))


def norm(a) -> Column:
    return F.expr(f"sqrt({dot_sql(a, a)})")


def cosine(a, b, norm_a=None, norm_b=None, eps: float = COSINE_EPS) -> Column:
    """``a . b / (max(|a|, eps) * max(|b|, eps))``.

    Pass precomputed norms when a vector takes part in many pairs: the norm is then
    computed once per vector instead of once per pair.
    """
    na = f"sqrt({dot_sql(a, a)})" if norm_a is None else _sql(norm_a)
    nb = f"sqrt({dot_sql(b, b)})" if norm_b is None else _sql(norm_b)
    return F.expr(f"{dot_sql(a, b)} / (greatest({na}, {eps!r}D) * greatest({nb}, {eps!r}D))")


def quantize(a, decimals: int) -> Column:
    """Round every component to ``decimals`` places (a quantized copy of the vector)."""
    scale = float(10 ** decimals)
    return F.expr(f"transform({_sql(a)}, x -> floor(x * {scale!r}D + 0.5D) / {scale!r}D)")
