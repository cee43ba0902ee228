"""Offline distillation losses over triplet tables (the training objective without the
training loop): Margin-MSE for cross-encoders and temperature KL for bi-encoders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distillery.functions.scoring import kl_divergence_pair_t


def margin_mse(
    triplets: DataFrame,
    student_pos: str,
    student_neg: str,
    margin_col: str = "score",
    by: Sequence[str] = (),
) -> DataFrame:
    """``mean(((s_pos - s_neg) - margin)^2)`` per ``by`` group: ``*by, loss, n``."""
    err = (F.col(student_pos) - F.col(student_neg)) - F.col(margin_col)
    return triplets.groupBy(*by).agg(F.avg(err * err).alias("loss"), F.count(F.lit(1)).alias("n"))


def distill_kl(
    triplets: DataFrame,
    teacher_pos: str,
    teacher_neg: str,
    student_pos: str,
    student_neg: str,
    temperature: float = 2.0,
    by: Sequence[str] = (),
) -> DataFrame:
    """``mean(KL(softmax(label/T) || softmax(student/T))) * T^2`` per group (batch-mean
    reduction); ``label = [teacher_pos, teacher_neg]``: ``*by, loss, n``."""
    kl = kl_divergence_pair_t(teacher_pos, teacher_neg, student_pos, student_neg, temperature)
    return triplets.groupBy(*by).agg(F.avg(kl).alias("loss"), F.count(F.lit(1)).alias("n"))


def margin_mse_wide(triplets: DataFrame, students: dict, margin_col: str = "score") -> DataFrame:
    """Several students in one pass: ``students = {name: (pos_col, neg_col)}`` ->
    one row ``n, <name>...`` (one scan and one aggregation for all of them)."""
    aggs = []
    for name, (sp, sn) in students.items():
        err = (F.col(sp) - F.col(sn)) - F.col(margin_col)
        aggs.append(F.avg(err * err).alias(name))
    return triplets.agg(F.count(F.lit(1)).alias("n"), *aggs)


def distill_kl_wide(triplets: DataFrame, teacher_pos: str, teacher_neg: str, variants: dict) -> DataFrame:
    """Several (student, temperature) variants in one pass:
    ``variants = {name: (student_pos, student_neg, T)}`` -> one row ``n, <name>...``."""
    aggs = [
        F.avg(kl_divergence_pair_t(teacher_pos, teacher_neg, sp, sn, temp)).alias(name)
        for name, (sp, sn, temp) in variants.items()
    ]
    return triplets.agg(F.count(F.lit(1)).alias("n"), *aggs)
