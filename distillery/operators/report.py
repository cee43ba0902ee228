"""Before/after comparison of metric tables and report formatting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distillery.functions.numeric import fix_decimals

UP, DOWN = "↑", "↓"

# ---- fixed values: number formats of the two report styles --------------------------
STYLES = {
    # value, absolute change, relative change
    "reranker": ("%.6f", "%+.6f", "%+.2f%%"),
    "embedding": ("%.4f", "%+.4f", "%+.2f"),
}
# -------------------------------------------------------------------------------------


def compare_runs(
    metrics: DataFrame,
    before: str = "before",
    after: str = "after",
    keys=("domain", "metric"),
    model_col: str = "model",
    value_col: str = "value",
    zero_base: str = "inf",
) -> DataFrame:
    """Match the two runs on ``keys`` ("before" drives; a key missing from "after" raises)
    and compute ``abs_change``, ``rel_change`` (percent) and ``direction``.

    ``zero_base``: relative change when before is 0 -- ``"inf"`` (+infinity, reranker
    report) or ``"zero"`` (0, embedding report). Division is guarded (ANSI mode).
    """
    if zero_base not in ("inf", "zero"):
        raise ValueError("zero_base must be 'inf' or 'zero'")
    m = F.col(model_col)
    wide = metrics.groupBy(*keys).agg(
        F.max(F.when(m == before, F.col(value_col))).alias("before"),
        F.max(F.when(m == after, F.col(value_col))).alias("after"),
    ).filter(F.col("before").isNotNull())
    after_c = F.when(
        F.col("after").isNull(), F.raise_error(F.lit(f"metric missing from run '{after}'"))
    ).otherwise(F.col("after")).cast("double")
    abs_change = after_c - F.col("before")
    at_zero = F.lit(float("inf")) if zero_base == "inf" else F.lit(0.0)
    rel = F.when(F.col("before") == 0, at_zero).otherwise(abs_change / F.col("before") * F.lit(100.0))
    return wide.select(
        *keys,
        "before",
        after_c.alias("after"),
        abs_change.alias("abs_change"),
        rel.alias("rel_change"),
        F.when(abs_change >= 0, F.lit(UP)).otherwise(F.lit(DOWN)).alias("direction"),
    )


def _fmt(fmt: str, col) -> F.Column:
    decimals = int(fmt.split(".")[1][0])
    # round first (deterministically), so the printed digits never depend on how an
    # engine breaks an exact half-way tie
    return F.format_string(fmt, fix_decimals(col, decimals))


def format_report(compared: DataFrame, style: str = "reranker") -> DataFrame:
    """Adds ``metric_label`` (upper-case), ``before_text``, ``after_text``, ``abs_text``,
    ``rel_text`` in the report style's number formats."""
    v, a, r = STYLES[style]
    rel = F.col("rel_change")
    rel_text = F.when(F.isnan(rel) | (F.abs(rel) == float("inf")),
                      F.concat(F.when(rel > 0, F.lit("+")).otherwise(F.lit("")), F.lit("inf"),
                               F.lit("%" if r.endswith("%%") else "")))
    return compared.select(
        "*",
        F.upper(F.col("metric")).alias("metric_label"),
        _fmt(v, F.col("before")).alias("before_text"),
        _fmt(v, F.col("after")).alias("after_text"),
        _fmt(a, F.col("abs_change")).alias("abs_text"),
        rel_text.otherwise(_fmt(r, rel)).alias("rel_text"),
    )
