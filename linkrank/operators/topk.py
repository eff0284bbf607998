"""The highest-ranked pages."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from linkrank import constants as C
from linkrank import folders

log = logging.getLogger(__name__)


def topk_pages(ranks: DataFrame, k: int = C.TOP_K, by: str = "rank", tie_digits: int | None = None,
               unique: bool = True, repeats: Observation | None = None) -> DataFrame:
    """``title`` and ``by`` of the ``k`` pages with the highest rank, in descending order.

    Equal ranks come in title order; ``tie_digits`` treats ranks that agree on so many
    decimals as equal, which hides the last bits of sums taken in another order. Pass
    ``unique=False`` when a title may occur twice: its best rank counts once. The tasks that
    merge its rows then also count them, and when the list has been computed, ``repeats``
    holds ``repeated_titles`` and ``repeated_rows``, what each of them has beyond one.
    """
    if k < 1:
        raise ValueError(f"k must be at least 1, got {k}")
    if unique and repeats is not None:
        raise ValueError("repeats are only counted with unique=False")
    pages = ranks.select("title", by)
    if not unique:
        pages = pages.groupBy("title").agg(F.max(by).alias(by), F.count("*").alias("rows"))
        if repeats is not None:
            pages = pages.observe(
                repeats, F.count_if(F.col("rows") > 1).alias("repeated_titles"),
                F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("repeated_rows"))
        pages = pages.drop("rows")
    order = F.col(by) if tie_digits is None else F.round(by, tie_digits)
    return pages.orderBy(order.desc(), "title").limit(k)


def topk_report(ranks: DataFrame, path: str, k: int = C.TOP_K, by: str = "rank", tie_digits: int | None = None,
                refuse: bool = False) -> tuple[DataFrame, dict[str, int]]:
    """The top list of ranks whose titles may repeat, stored at ``path``, and how many did.

    One pass makes both. A repeated title counts once, with its best rank, and is logged; with
    ``refuse`` it is an error, and ``path`` is left as it was.
    """
    spark, repeats = ranks.sparkSession, Observation()
    top = topk_pages(ranks, k, by, tie_digits, unique=False, repeats=repeats)

    def write(folder: str) -> None:
        # Few rows, in order: one file.
        top.write.parquet(folder)
        if found := repeats.get["repeated_titles"]:
            message = f"{found} titles occur more than once, in {repeats.get['repeated_rows']} rows too many"
            if refuse:
                raise ValueError(message)
            log.error(message)

    folders.replace(spark, path, write)
    return spark.read.schema(top.schema).parquet(path), dict(repeats.get)
