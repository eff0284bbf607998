"""Joins on keys of which a few may hold a large part of all rows.

A hot key is split: its rows spread over several values of ``split`` and the one
row of the other side is copied to each of them. Every row still meets its
partner, so results do not change.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot above this share of all rows, so fewer than 1 / HOT_SHARE keys can be
# hot and the list of them is small enough to broadcast whatever the data.
HOT_SHARE = 1 / 10_000

# Below this many rows one task copes with a key anyway.
HOT_ROWS = 1_000_000


def hot_limit(total_rows: int, hot_rows: int = HOT_ROWS) -> int:
    """Rows a key may have before it is split."""
    return max(hot_rows, math.ceil(total_rows * HOT_SHARE))


def hot_keys(counts: DataFrame, count: str, limit: int) -> DataFrame:
    """``counts`` of the keys above ``limit`` with the number of ``splits`` each needs."""
    splits = F.ceil(F.col(count) / F.lit(limit)).cast("int")
    return counts.where(F.col(count) > limit).withColumn("splits", splits).drop(count)


def split_rows(rows: DataFrame, key: str, spread_by: str, hot: DataFrame) -> DataFrame:
    """Add ``split``: 0, or for a hot key one of its splits, chosen by ``spread_by``."""
    split = F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("splits")).cast("int"), F.lit(0))
    return rows.join(F.broadcast(hot), key, "left").withColumn("split", split).drop("splits")


def copy_to_splits(unique_rows: DataFrame, splits: str = "splits") -> DataFrame:
    """One copy per split of a row that says how many ``splits`` its key has."""
    numbers = F.sequence(F.lit(0), F.col(splits) - 1)
    return unique_rows.withColumn("split", F.explode(numbers)).drop(splits)
