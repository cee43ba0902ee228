"""Teacher-score and distillation-loss column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from distillery.functions.numeric import _c

# ---- fixed values (teacher output convention) ---------------------------------------
# A token missing from the returned top log-probabilities counts as log-prob -10.0.
MISSING_LOGPROB = -10.0
YES_TOKEN = "yes"
NO_TOKEN = "no"
# ------------------------------------------------------------------------------------


def logprob_or_floor(logprobs, token: str, floor: float = MISSING_LOGPROB) -> Column:
    """``logprobs[token]`` or ``floor`` when the token was not returned."""
    return F.coalesce(_c(logprobs).getItem(token), F.lit(float(floor)))


def yes_no_logit(logprobs, floor: float = MISSING_LOGPROB) -> Column:
    """Raw log-odds ``lp(yes) - lp(no)`` (no sigmoid); both missing gives 0.0."""
    return logprob_or_floor(logprobs, YES_TOKEN, floor) - logprob_or_floor(logprobs, NO_TOKEN, floor)


def log_softmax_t(scores, temperature: float = 1.0) -> Column:
    """Log-softmax of ``scores / T`` over an ``array<double>`` (max-shifted, stable)."""
    if temperature <= 0:
        raise ValueError("temperature must be positive")
    t = F.lit(float(temperature))
    arr = _c(scores)
    shift = F.array_max(arr) / t
    lse = F.log(F.aggregate(F.transform(arr, lambda x: F.exp(x / t - shift)), F.lit(0.0), lambda a, x: a + x))
    return F.transform(arr, lambda x: x / t - shift - lse)


def softmax_t(scores, temperature: float = 1.0) -> Column:
    return F.transform(log_softmax_t(scores, temperature), lambda x: F.exp(x))


def kl_divergence_t(teacher_scores, student_scores, temperature: float = 1.0) -> Column:
    """Per-row ``KL(softmax(teacher/T) || softmax(student/T)) * T^2``.

    Terms with zero teacher probability contribute 0 (x log x -> 0).
    """
    lt = log_softmax_t(teacher_scores, temperature)
    ls = log_softmax_t(student_scores, temperature)
    terms = F.zip_with(lt, ls, lambda a, b: F.when(F.exp(a) > 0, F.exp(a) * (a - b)).otherwise(F.lit(0.0)))
    kl = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    return kl * F.lit(float(temperature) ** 2)


def _log_softmax2(a, b, temperature: float):
    t = F.lit(float(temperature))
    shift = F.greatest(a, b) / t
    lse = F.log(F.exp(a / t - shift) + F.exp(b / t - shift))
    return a / t - shift - lse, b / t - shift - lse


def kl_divergence_pair_t(teacher_pos, teacher_neg, student_pos, student_neg, temperature: float = 1.0) -> Column:
    """:func:`kl_divergence_t` for two-entry labels ``[pos, neg]`` written as plain column
    arithmetic (no lambdas), so it compiles into whole-stage codegen."""
    if temperature <= 0:
        raise ValueError("temperature must be positive")
    lt = _log_softmax2(_c(teacher_pos), _c(teacher_neg), temperature)
    ls = _log_softmax2(_c(student_pos), _c(student_neg), temperature)
    total = F.lit(0.0)
    for a, b in zip(lt, ls):
        total = total + F.when(F.exp(a) > 0, F.exp(a) * (a - b)).otherwise(F.lit(0.0))
    return total * F.lit(float(temperature) ** 2)
