"""Deterministic decimal rounding.

``round()`` differs between engines on exact half-way values (Spark rounds the shortest
decimal form half-up, other engines round the binary value). ``floor(x * 10^d + 0.5) / 10^d``
is plain IEEE arithmetic, so every engine produces the same double. Scores are fixed to 9
decimals before ranking (stable tie groups) and reported values to 6.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fix_decimals(col, decimals: int) -> Column:
    scale = float(10 ** decimals)
    if isinstance(col, str):
        return F.expr(f"floor(`{col}` * {scale!r}D + 0.5D) / {scale!r}D")
    return F.floor(col * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def fix9(col) -> Column:
    return fix_decimals(col, 9)


def fix6(col) -> Column:
    return fix_decimals(col, 6)
