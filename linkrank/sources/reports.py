"""Small results: counters and the top list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank import folders
from linkrank.sources.adjacency_text import unbroken


def write_counters(counters: DataFrame, path: str) -> None:
    """``metric, value`` rows as JSON lines in one file, replacing ``path``."""
    folders.replace(counters.sparkSession, path, counters.coalesce(1).write.json)


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("metric STRING, value BIGINT").json(path)


def write_topk_text(top: DataFrame, path: str) -> None:
    """``title \\t rank`` lines in one file, in the order of ``top``, replacing ``path``.

    A top list has already been cut to k rows in one partition, so one file costs nothing.
    A title with a line break fails the job.
    """
    title, rank = top.columns
    line = F.concat_ws("\t", unbroken(F.col(title), r"[\n\r]"), F.col(rank).cast("string"))
    folders.replace(top.sparkSession, path, top.select(line.alias("value")).coalesce(1).write.text)


def read_topk_text(spark: SparkSession, path: str, rank: str = "rank") -> DataFrame:
    """``title`` and ``rank`` of a top list; a title may contain tabs."""
    number = F.substring_index("value", "\t", -1)
    title = F.left("value", F.length("value") - F.length(number) - 1)
    return spark.read.text(path).select(title.alias("title"), number.cast("double").alias(rank))
