"""Bounded samples of labelled rows, and what their models share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(parts: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``parts`` (null ids: 0)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts, F.lit(0))


def labelled_sample(labelled: DataFrame, label: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows (doc_id, label) of each class, at most twice so many, chosen by hash.

    The share that is kept follows from a count per class, so no class is ranked as a whole.
    Labels must be few: there is one count for each.
    """
    rows = labelled.select("doc_id", label).where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    # One row per id and label, so that repeated rows have no more weight than others.
    rows = rows.distinct()
    counts = {row[label]: row["count"] for row in rows.groupBy(label).count().collect()}
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for value, count in counts.items():
        share = F.when(F.col(label) == value, F.lit(min(1.0, per_class / count))).otherwise(share)
    return rows.where(mark < share).limit(2 * per_class * max(1, len(counts)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
