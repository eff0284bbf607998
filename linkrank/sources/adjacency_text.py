"""Adjacency lines as text: ``title \\t TYPE \\t rank [\\t link]*``.

Pages with too many links for one line take several; all but the first have an empty
first link. Only a reader that asks for it takes that as the mark of a continued page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank import constants as C
from linkrank import folders

_BREAKS = r"[\t\n\r]"
_NUMBER = r"[+-]?(?:NaN|Infinity|(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?[fFdD]?)"
_SOUND_LINE = rf"^[^\t]*\t(?:{'|'.join(C.PAGE_TYPES)})\t{_NUMBER}(?:\t|$)"


def _failure(message: str, culprit: Column) -> Column:
    return F.raise_error(F.concat(F.lit(message + ": "), F.coalesce(culprit, F.lit("NULL"))))


def unbroken(text: Column, breaks: str = _BREAKS) -> Column:
    """``text``, which fails the job if a line could not hold it."""
    return F.when(F.rlike(text, F.lit(breaks)), _failure("tab or line break in", text)).otherwise(text)


def read_adjacency_text(spark: SparkSession, path: str | list[str], continued_pages: bool = False) -> DataFrame:
    """``title, type, rank, links, continued``; a malformed line fails the job.

    With ``continued_pages`` a line whose first link is empty continues its title's list;
    without, an empty first link is a link and no row is continued.
    """
    line = F.col("value")
    # A condition, not a column: it holds whatever columns the reader's user selects.
    is_sound = F.when(F.rlike(line, F.lit(_SOUND_LINE)), F.lit(True)).otherwise(
        _failure("malformed adjacency line", line).cast("boolean")
    )
    # Empty fields at the end of a line do not count.
    fields = F.split(F.regexp_replace(line, r"\t+\z", ""), "\t")
    continued = F.coalesce(F.get("fields", F.lit(3)) == "", F.lit(False)) & F.lit(continued_pages)
    first_link = F.when(continued, 5).otherwise(4)
    return (
        spark.read.text(path)
        .where(is_sound)
        .select(fields.alias("fields"))
        .select(
            F.get("fields", F.lit(0)).alias("title"),
            F.get("fields", F.lit(1)).alias("type"),
            F.get("fields", F.lit(2)).cast("double").alias("rank"),
            F.array_distinct(F.slice("fields", first_link, F.size("fields"))).alias("links"),
            continued.alias("continued"),
        )
    )


def write_adjacency_text(adjacency: DataFrame, path: str) -> None:
    """Write adjacency rows, replacing ``path``, which they may come from; fails on what the format cannot hold."""
    is_known = F.coalesce(F.col("type").isin(*C.PAGE_TYPES), F.lit(False))
    page_type = F.when(is_known, F.col("type")).otherwise(
        _failure("page type cannot be stored", F.col("type"))
    )

    fields = F.concat(
        F.array(unbroken(F.col("title")), page_type, F.col("rank").cast("string")),
        F.when(F.col("continued"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>")),
        F.transform("links", lambda link: unbroken(link)),
    )
    lines = adjacency.select(F.array_join(fields, "\t").alias("value"))
    folders.replace(adjacency.sparkSession, path, lines.write.text)
