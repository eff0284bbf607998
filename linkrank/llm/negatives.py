"""Hard negatives by a vertical scan: columns in the order of the anchor's magnitudes, a shrinking set of candidates."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkrank.session import scratch_folder, stored

#: Components are counted in steps of 1 / SCALE.
SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: A negative's score is at least and at most so many hundredths of its positive's.
LOW, HIGH = 50, 95
BLOCK_ROWS = 4096
PACK_ROWS = 512
#: Columns read before candidates are looked at again.
STEP = 16
#: Partitions of one join at most.
MOST_PARTITIONS = 10_000


def whole(vector: str) -> Column:
    """Not null, and finite in every component."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def quantised(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Components as whole numbers; one that a product of 62 bits cannot hold is an error."""
    out = np.floor(vectors * scale)
    if out.size and np.abs(out).max() >= 2.0 ** 62:
        raise ValueError("a vector's components are too large for whole-number scores")
    return out.astype(np.int64)


class Block:
    """Rows of one dimension as columns, with each column's least and largest value."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, columns: np.ndarray):
        self.ids, self.labels, self.columns = ids, labels, columns
        self.low = columns.min(axis=1) if columns.size else np.zeros(len(columns), columns.dtype)
        self.high = columns.max(axis=1) if columns.size else np.zeros(len(columns), columns.dtype)

    def only(self, rows: np.ndarray) -> Block:
        return Block(self.ids[rows], self.labels[rows], np.ascontiguousarray(self.columns[:, rows]))

    def exact_type(self, queries: np.ndarray):
        """Doubles where they hold every score to the last bit, else 64-bit numbers."""
        most = max([1, *map(int, np.abs(self.columns).max(axis=1, initial=0))])
        bound = most * int(np.abs(queries).max(initial=0)) * max(1, len(self.columns))
        if bound >= 1 << 62:
            raise ValueError("a vector's components are too large for whole-number scores")
        return np.float64 if bound < 1 << 53 else np.int64

    def scan(self, query: np.ndarray, rows: np.ndarray | None, wanted):
        """Numbers of the rows that ``wanted`` leaves, and their scores, exact.

        Columns are read in the order of the query's magnitudes there, largest first. After
        each few, ``wanted(lower, upper)`` sees what the scores can still be, from the sums so
        far and the least and largest that the unread columns can add, and says which rows go
        on. ``rows`` (or None for all) are those to begin with.
        """
        order = np.argsort(-np.abs(query), kind="stable")
        order = order[:np.count_nonzero(query)]
        ends = self.low[order] * query[order], self.high[order] * query[order]
        rest_low = np.append(np.cumsum(np.minimum(*ends)[::-1])[::-1], 0)
        rest_high = np.append(np.cumsum(np.maximum(*ends)[::-1])[::-1], 0)
        sums = np.zeros(len(self.ids) if rows is None else len(rows), dtype=self.columns.dtype)
        keep = wanted(sums + rest_low[0], sums + rest_high[0])
        for start in range(0, len(order) + 1, STEP):
            if not keep.all():
                rows = np.flatnonzero(keep) if rows is None else rows[keep]
                sums = sums[keep]
            if start >= len(order) or not len(sums):
                break
            read = order[start:start + STEP]
            part = self.columns[read]
            sums = sums + query[read] @ (part if rows is None else part[:, rows])
            keep = wanted(sums + rest_low[start + len(read)], sums + rest_high[start + len(read)])
        else:
            if not keep.all():
                rows = np.flatnonzero(keep) if rows is None else rows[keep]
                sums = sums[keep]
        return (np.arange(len(self.ids)) if rows is None else rows), sums

    def best(self, query: np.ndarray, skip: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows other than ``skip``, ties to the smaller id."""
        def wanted(lower, upper):
            if len(lower) <= k:
                return np.ones(len(lower), dtype=bool)
            return upper >= np.partition(lower, len(lower) - k)[len(lower) - k]

        # Without its own row, which could push another out.
        rows, scores = self.scan(query, np.flatnonzero(self.ids != skip), wanted)
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows][order], scores[order]

    def windows(self, query: np.ndarray, rows: np.ndarray, limits: list[tuple[int, int]], k: int):
        """For each (least, most): ids and scores of the ``k`` best of ``rows`` with a score in it."""
        floor, top = min(low for low, _ in limits), max(high for _, high in limits)

        def wanted(lower, upper):
            keep = (upper >= floor) & (lower <= top)
            left_low, left_high = lower[keep], upper[keep]
            # Below this, a row is among the best of no window.
            least = None
            for low, high in limits:
                sure = left_low[(left_low >= low) & (left_high <= high)]
                needed = np.partition(sure, len(sure) - k)[len(sure) - k] if len(sure) >= k else low
                least = needed if least is None else min(least, needed)
            return keep & (upper >= least)

        rows, scores = self.scan(query, rows, wanted)
        ids = self.ids[rows]
        order = np.lexsort((ids, -scores))
        ids, scores = ids[order], scores[order]
        for low, high in limits:
            inside = np.flatnonzero((scores >= low) & (scores <= high))[:k]
            yield ids[inside], scores[inside]


def _dense(values: pa.Array, count: int) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).reshape(count, -1 if count and len(values.flatten()) else 0)


def _blocks(rows: DataFrame, blocks: int, scale: int) -> DataFrame:
    """A row per block, with its columns one after the other."""
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))

    def packed(table: pa.Table) -> pa.Table:
        ids, labels = table.column("id").to_numpy(), table.column("label").to_numpy()
        vectors = quantised(_dense(table.column("vector").combine_chunks(), len(ids)), scale)
        order = np.lexsort((labels, ids))
        return pa.table({
            "dimension": table.column("dimension").slice(0, 1), "block": table.column("block").slice(0, 1),
            "ids": [ids[order].tobytes()], "labels": [labels[order].tobytes()],
            "columns": [np.ascontiguousarray(vectors[order].T).tobytes()]})

    return dealt.groupBy("dimension", "block").applyInArrow(
        packed, "dimension int, block int, ids binary, labels binary, columns binary")


def _met(packs: DataFrame, index: DataFrame, blocks: int) -> DataFrame:
    """Every pack of anchors with every block of its dimension, by an equal join."""
    parts = min(blocks, MOST_PARTITIONS)
    spread = packs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    left = spread.repartition(parts, "dimension", "block")
    return left.join(index.repartition(parts, "dimension", "block"), ["dimension", "block"]).drop("block", "dimension")


def _read(batch: pa.RecordBatch, row: int, scale: int):
    """The block and the anchors (struct array, vectors) of a joined row."""
    get = lambda name, kind: np.frombuffer(batch.column(name)[row].as_buffer(), dtype=kind)
    ids = get("ids", np.int64)
    block = Block(ids, get("labels", np.int64), get("columns", np.int64).reshape(-1, len(ids)))
    anchors = batch.column("anchors")[row].values
    vectors = quantised(_dense(anchors.field("vector"), len(anchors)), scale)
    exact = block.exact_type(vectors)
    return Block(block.ids, block.labels, block.columns.astype(exact)), anchors, vectors.astype(exact)


def _packs(anchors: DataFrame, packs: int) -> DataFrame:
    """Anchors (key, id, label, vector, dimension, ...) in rows of about ``PACK_ROWS``."""
    columns = [name for name in anchors.columns if name != "dimension"]
    dealt = anchors.withColumn("pack", F.pmod(F.col("key"), F.lit(packs)))
    return dealt.groupBy("dimension", "pack").agg(F.collect_list(F.struct(*columns)).alias("anchors")).drop("pack")


def hard_negatives(vectors: DataFrame, anchors: DataFrame, id_column: str = "vec_id", vector: str = "embedding",
                   label: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
                   high: int = HIGH, scale: int = SCALE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    A score is the inner product of two vectors whose components x have become
    floor(``scale`` * x). An anchor's positives are its ``positives`` best rows with its label;
    for each, the best ``negatives`` rows with another label are given whose score is between
    ``low`` and ``high`` hundredths of the positive's. Ties go to the smaller id.

    Every anchor is held against all rows, block by block, once for its positives and once for
    the negatives; of each block only so many rows per anchor and positive come out. Labels
    are whole numbers. Rows without id, label or vector, or with a component that is null or
    not finite, take no part, neither as rows nor as anchors; vectors are compared with those of their
    own dimension only. Rows repeated in full count once, a row with the anchor's id is never
    its partner, and an id with several vectors or labels is an anchor for each. Empty tables
    give no rows. Scores beyond 62 bits fail the job.
    """
    folder = scratch_folder(vectors.sparkSession, "negatives")

    def sound(table: DataFrame) -> DataFrame:
        named = table.select(F.col(id_column).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                             F.col(vector).cast("array<double>").alias("vector"))
        named = named.where(whole("vector") & F.col("id").isNotNull() & F.col("label").isNotNull())
        return named.distinct().withColumn("dimension", F.size("vector"))

    rows = stored(sound(vectors), f"{folder}/rows")
    blocks = max(1, math.ceil(rows.count() / block_rows))
    index = stored(_blocks(rows, blocks, scale), f"{folder}/index")
    asking = stored(sound(anchors).withColumn("key", F.monotonically_increasing_id()), f"{folder}/anchors")
    packs = max(1, math.ceil(asking.count() / PACK_ROWS))

    def nearest(batches):
        for batch in batches:
            out = [[], [], []]
            for row in range(batch.num_rows):
                block, asked, queries = _read(batch, row, scale)
                labels = asked.field("label").to_numpy()
                same = {value: block.only(block.labels == value) for value in np.unique(labels).tolist()}
                keys, ids = asked.field("key").to_numpy(), asked.field("id").to_numpy()
                for i in range(len(asked)):
                    found, scores = same[int(labels[i])].best(queries[i], ids[i], positives)
                    out[0].append(np.full(len(found), keys[i]))
                    out[1].append(found)
                    out[2].append(scores.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.zeros(0, np.int64), *part])) for part in out], names=["key", "other", "score"])

    near = _met(_packs(asking, packs), index, blocks).mapInArrow(nearest, "key long, other long, score long")
    line = Window.partitionBy("key").orderBy(F.desc("score"), "other")
    best = near.withColumn("positive", F.row_number().over(line)).where(F.col("positive") <= positives)
    best = stored(best, f"{folder}/positives")
    # At most ``positives`` for an anchor.
    wanted = best.groupBy("key").agg(F.collect_list(F.struct("positive", "score")).alias("wanted"))

    def between(batches):
        for batch in batches:
            out = [[], [], [], []]
            for row in range(batch.num_rows):
                block, asked, queries = _read(batch, row, scale)
                labels, keys = asked.field("label").to_numpy(), asked.field("key").to_numpy()
                others = {value: np.flatnonzero(block.labels != value) for value in np.unique(labels).tolist()}
                ids, windows = asked.field("id").to_numpy(), asked.field("wanted").to_pylist()
                for i in range(len(asked)):
                    limits = [(-(-low * w["score"] // 100), high * w["score"] // 100) for w in windows[i]]
                    asked_for = [(w["positive"], limit) for w, limit in zip(windows[i], limits, strict=True) if limit[0] <= limit[1]]
                    if not asked_for:
                        continue
                    rest = others[int(labels[i])]
                    rest = rest[block.ids[rest] != ids[i]]
                    found = block.windows(queries[i], rest, [limit for _, limit in asked_for], negatives)
                    for (positive, _), (other, scores) in zip(asked_for, found, strict=True):
                        out[0].append(np.full(len(other), keys[i]))
                        out[1].append(np.full(len(other), positive))
                        out[2].append(other)
                        out[3].append(scores.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.zeros(0, np.int64), *part])) for part in out],
                names=["key", "positive", "negative_id", "negative_score"])

    # Windows below zero are empty: 95 hundredths of a negative score are more than 50.
    packed = _packs(asking.join(wanted, "key"), packs)
    found = _met(packed, index, blocks).mapInArrow(
        between, "key long, positive long, negative_id long, negative_score long")
    line = Window.partitionBy("key", "positive").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= negatives)
    told = best.select("key", F.col("positive").cast("long").alias("positive"), F.col("other").alias("positive_id"),
                       F.col("score").alias("positive_score"))
    return found.join(told, ["key", "positive"]).join(asking.select("key", F.col("id").alias("anchor_id")), "key").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
