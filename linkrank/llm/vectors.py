"""Which vectors take part in searches and joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null, not empty, finite in every component, and of a length that is neither 0 nor infinite."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    square = F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x)
    return F.coalesce(finite & (F.size(values) > 0) & (square > 0) & (square < float("inf")), F.lit(False))


def usable_rows(df: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector takes part, with its components as doubles."""
    return df.where(usable(vector)).withColumn(vector, F.col(vector).cast("array<double>"))
