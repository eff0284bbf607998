"""Exact duplicates: rows grouped by a 128-bit content hash, the bytes of each group compared."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.operators.skew import HOT_ROWS, copy_to_splits, hot_keys, hot_limit, split_rows
from linkrank.session import scratch_folder, stored

KEY_BITS = 128
#: The table of bits that tells rows without a copy from others: so many words of 64 bits, whatever the input.
FILTER_WORDS = 1 << 18


def normalised(text: str = "text") -> Column:
    """A text with A-Z in lower case; null counts as empty."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def _key(bits: int) -> Column:
    return F.unhex(F.left("text_sha256", F.lit(bits // 4)))


def _may_be_in(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose ``key`` may be one of ``keys``: a bit each in a broadcast table of fixed size.

    Others that share a bit pass too, so this only saves work.
    """
    place = F.pmod(F.xxhash64("key"), F.lit(64 * FILTER_WORDS))
    marked = keys.select(place.alias("place")).select(
        F.shiftright("place", 6).alias("word"), (F.col("place") % 64).cast("int").alias("bit"))
    table = marked.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    placed = rows.withColumn("place", place).withColumn("word", F.shiftright("place", 6))
    met = placed.join(F.broadcast(table), "word").where(F.getbit("bits", F.col("place") % 64) == 1)
    return met.select(*rows.columns)


def _groups(rows: DataFrame, *by: str) -> DataFrame:
    """Size, largest doc_id and the one row that stays of each group; sums and extremes only, so tasks combine first."""
    return rows.groupBy(*by).agg(
        F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"),
        F.coalesce(F.max_by("row", "doc_id"), F.max("row")).alias("keep_row"))


def exact_copies(docs: DataFrame, bits: int = KEY_BITS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of ``docs``.

    Texts are equal if they are the same bytes after lower-casing A-Z; null counts as empty.
    Of equal texts the row with the largest doc_id stays. Of rows that repeat this doc_id one
    is kept, and of a group without any doc_id (its keep_id is null) one too; other columns
    do not matter. An empty table gives no rows.

    Rows meet by the first ``bits`` bits of their text's SHA-256. Texts whose hash occurs
    twice are then grouped by hash and bytes, after each task has merged the copies it saw;
    where a hash turns out to stand for several texts, its rows are grouped by text instead.
    Rows of a hash with over ``hot_rows`` rows are spread over many tasks.
    """
    spark, folder = docs.sparkSession, scratch_folder(docs.sparkSession, "copies")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("text")).withColumn(
        "text_sha256", F.sha2("text", 256))
    # Numbers of rows are given once, in a table: later jobs read them and do not give them anew.
    rows = stored(texts.select(
        "doc_id", "text_sha256", F.monotonically_increasing_id().alias("row")), f"{folder}/rows")
    rows = rows.withColumn("key", _key(bits))
    groups = stored(_groups(rows, "key").where("group_size > 1"), f"{folder}/groups")

    compared = _may_be_in(texts.withColumn("key", _key(bits)), groups).groupBy("key", "text").agg(F.count("*").alias("n"))
    clashes = compared.groupBy("key").agg(F.count("*").alias("texts")).where("texts > 1").select("key")
    clashes = stored(clashes, f"{folder}/clashes")

    total = rows.count()
    hot = hot_keys(groups.select("key", "group_size"), "group_size", hot_limit(total, hot_rows))
    splits = F.greatest(F.ceil(F.col("group_size") / F.lit(hot_limit(total, hot_rows))), F.lit(1)).cast("int")
    spread = split_rows(rows, "key", "row", hot)
    told = spread.join(copy_to_splits(groups.withColumn("splits", splits)), ["key", "split"], "left")
    alone = F.col("group_size").isNull()
    out = told.select(
        "key", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), "text_sha256")
    if clashes.isEmpty():
        return out.drop("key")
    # Texts of a clash: rows are told apart by (key, text, doc_id), and one of equal ones is kept.
    clashing = texts.withColumn("key", _key(bits)).join(clashes, "key", "left_semi")
    same = clashing.groupBy("key", "text", "text_sha256", "doc_id").agg(F.count("*").alias("n"))
    whole = same.groupBy("key", "text").agg(F.sum("n").alias("group_size"), F.max("doc_id").alias("keep_id"))
    apart = same.join(whole, ["key", "text"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return out.join(clashes, "key", "left_anti").drop("key").unionByName(
        apart.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256"))
