"""Connected components, and groups whose members meet in blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.session import drop_scratch, scratch_folder, stored


def _edges(df: DataFrame) -> DataFrame:
    return (
        df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a <> b").distinct()
    )


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Joins neighbours of each node (the larger or the smaller ones) to its least neighbour."""
    around = edges if not larger else edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    if larger:
        around = around.toDF("node", "other")
    else:
        around = around.select(F.col("b").alias("node"), F.col("a").alias("other"))
    least = around.groupBy("node").agg(F.min("other").alias("low"))
    joined = around.join(least.withColumn("low", F.least("low", "node")), "node")
    if larger:
        moved = joined.where("other > node").select(F.col("other").alias("a"), F.col("low").alias("b"))
    else:
        moved = joined.select(F.col("other").alias("a"), F.col("low").alias("b")).union(
            least.select(F.col("node").alias("a"), F.col("low").alias("b")))
    return _edges(moved)


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the smallest id reachable) of every node of ``edges`` (a, b).

    Alternates large and small stars, written to the shared folder after each step, until
    nothing changes: then every node hangs on its component's least. No group is gathered:
    a step is a partial minimum and a join. A step's table goes when the next but one is
    written. Nulls make no edge; an empty table gives none.
    """
    spark, folder = edges.sparkSession, scratch_folder(edges.sparkSession, "components")
    now = stored(_edges(edges.where("a IS NOT NULL AND b IS NOT NULL")), f"{folder}/0")
    mark, step = _mark(now), 0
    while mark[0]:
        step += 1
        now = stored(_stars(_stars(now, larger=True), larger=False), f"{folder}/{step}")
        before, mark = mark, _mark(now)
        if step > 1:
            drop_scratch(spark, f"{folder}/{step - 2}")
        if before == mark:
            break
    ids = now.select(F.col("b").alias("id"), F.col("a").alias("component"))
    return ids.union(now.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def pairs_of_blocks(packed: DataFrame, *of: str) -> DataFrame:
    """Rows (rows, others): each block (``of``, block, blocks, rows) alone, and each two that belong together.

    So the members of a group meet each other however many they are, and no two of them are a row.
    """
    alone = packed.select("rows", F.lit(None).cast(packed.schema["rows"].dataType).alias("others"))
    several = packed.where("blocks > 1")
    left = several.where("block < blocks - 1").withColumn(
        "other", F.explode(F.sequence(F.col("block") + 1, F.col("blocks") - 1)))
    right = several.select(*of, F.col("block").alias("other"), F.col("rows").alias("others"))
    return alone.unionByName(left.join(right, [*of, "other"]).select("rows", "others"))


def packed_groups(members: DataFrame, most: int, *of: str) -> DataFrame:
    """Rows (rows, others) in which the ``row`` structs (with an ``id``) of ``members`` meet those of their group.

    A group (``of``) of more than ``most`` members is dealt to several blocks.
    """
    counts = members.groupBy(*of).count().where(F.col("count") > most)
    large = counts.select(*of, F.ceil(F.col("count") / most).cast("int").alias("blocks"))
    if large.isEmpty():
        rows = members.groupBy(*of).agg(F.collect_list("row").alias("rows"))
        return rows.select("rows", F.lit(None).cast(rows.schema["rows"].dataType).alias("others"))
    dealt = members.join(large, list(of), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("row.id"), F.col("blocks")).cast("int"))
    packed = dealt.groupBy(*of, "block").agg(F.first("blocks").alias("blocks"), F.collect_list("row").alias("rows"))
    return pairs_of_blocks(packed, *of)


def list_sizes(lists: pa.ListArray) -> np.ndarray:
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def both(lists: list[pa.ListArray], name: str) -> pa.Array:
    """The field ``name`` of all structs, row by row: those of a row's first list, then those of its second."""
    parts = [column.flatten().field(name) for column in lists]
    if not len(parts[1]):
        return pa.concat_arrays([parts[0]])
    sizes = [list_sizes(column) for column in lists]
    owner = np.concatenate([np.repeat(np.arange(len(size)), size) for size in sizes])
    return pa.concat_arrays(parts).take(pa.array(np.argsort(owner, kind="stable")))


def forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what a symmetric matrix of links connects."""
    left, out = np.ones(len(near), dtype=bool), []
    for root in range(len(near)):
        if not left[root]:
            continue
        left[root], todo = False, [root]
        while todo:
            at = todo.pop()
            new = np.flatnonzero(near[at] & left)
            left[new] = False
            out += [(at, int(other)) for other in new]
            todo += new.tolist()
    return out
