"""Arithmetic on probabilities that are stored as natural logarithms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NEGATIVE_INFINITY = float("-inf")


def safe_ln(value: Column) -> Column:
    """``ln`` with ``ln(0) = -Infinity``; Spark's own ``ln(0)`` is NULL."""
    return F.when(value == 0, F.lit(NEGATIVE_INFINITY)).otherwise(F.ln(value))


def log_add(left: Column, right: Column) -> Column:
    """``ln(exp(left) + exp(right))`` without leaving log space; -Infinity is the identity."""
    larger, smaller = F.greatest(left, right), F.least(left, right)
    return F.when(smaller == NEGATIVE_INFINITY, larger).otherwise(
        larger + F.log1p(F.exp(smaller - larger))
    )
