"""Word counts in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_between(text: str, gap: str) -> Column:
    """How many words stand between runs of ``gap`` (a pattern) in a column; 0 for null.

    Splitting is several times as fast as matching the words. An empty piece can only be
    the first or the last.
    """
    words = F.split(text, gap)
    first, last = F.get(words, F.lit(0)), F.element_at(words, -1)
    empty = F.when(first == "", 1).otherwise(0) + F.when((last == "") & (F.size(words) > 1), 1).otherwise(0)
    return F.coalesce(F.size(words) - empty, F.lit(0)).cast("long")
