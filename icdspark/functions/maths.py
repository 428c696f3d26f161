"""Scalar maths on scores and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from icdspark.functions._util import as_col


def sigmoid(logit) -> Column:
    """c16: 1 / (1 + exp(-x))."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-as_col(logit)))


def binarize(score) -> Column:
    """c17: round-half-to-even of a probability: exactly 0.5 gives 0."""
    return (as_col(score) > F.lit(0.5)).cast("int")


def safe_ratio(num, den, zero_div=0.0) -> Column:
    """c20: num / den with 0/0 (and x/0) mapped to ``zero_div`` (None keeps null)."""
    ratio = F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))
    return ratio if zero_div is None else F.coalesce(ratio, F.lit(zero_div))
