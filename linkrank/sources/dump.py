"""Scan of text files that hold tagged records, such as XML dumps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank import constants as C


#: Bits of ``monotonically_increasing_id`` that number the rows of a partition.
_ROW_BITS = 33


def _one_split_a_task(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark``, but for one: a task reads one split of one file.

    A split then costs, by that setting, more than a task may hold.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set("spark.sql.files.openCostInBytes", "64g")
    return session


def read_tagged_records(spark: SparkSession, path: str | list[str], start_tag: str = C.PAGE_START,
                        end_tag: str = C.PAGE_END) -> DataFrame:
    """``rec``: each span from ``start_tag`` to ``end_tag``, both included.

    The start tag serves as the line separator of Spark's text source, so files
    split into many tasks (bzip2 too) and a record that crosses a split is read
    once. Text outside the tags and a record cut off at the end of a file are
    left out. Compression follows the file extension.

    What stands before a file's first start tag is no record either, also if it holds an
    end tag, as in a part of a dump that was cut in the middle of a page. It is the first
    row of the file's first split, and as a task reads one split, the first row of its task.
    A start tag within a record begins the record anew.
    """
    read = _one_split_a_task(spark).read.option("lineSep", start_tag).text(path)
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    chunks = read.select("value", F.col("_metadata.file_block_start").alias("start"), number.alias("number"))
    # Joined to nothing, the rows belong to the caller's session again.
    chunks = spark.sql("SELECT '' AS value, 0L AS start, 0L AS number WHERE false").unionAll(chunks)
    is_head = (F.col("start") == 0) & (F.col("number") == 0)
    return chunks.where(~is_head & (F.instr("value", end_tag) > 0)).select(
        F.concat(
            F.lit(start_tag), F.substring_index("value", end_tag, 1), F.lit(end_tag)
        ).alias("rec")
    )
