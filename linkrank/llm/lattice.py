"""Near-duplicate embeddings by cells of the E8 lattice."""

from __future__ import annotations

from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.components import both, components, forest, list_sizes, packed_groups
from linkrank.llm.vectors import usable, usable_rows
from linkrank.session import scratch_folder, stored

LEAST_COSINE = 0.93
#: Chosen so that two vectors at the least cosine meet in some table with a chance of 0.999.
TABLES = 10
SCALE = 1.0
PROBES = 8
BLOCK_ROWS = 1024
SEED = 5
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8: steps to the neighbouring cells."""
    pairs = []
    for (i, j), (a, b) in product(combinations(range(8), 2), product((1.0, -1.0), repeat=2)):
        step = [0.0] * 8
        step[i], step[j] = a, b
        pairs.append(step)
    halves = [signs for signs in product((0.5, -0.5), repeat=8) if sum(s < 0 for s in signs) % 2 == 0]
    return np.array(pairs + [list(h) for h in halves])


ROOTS = _roots()


def _even_point(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum: if it is odd, the worst coordinate goes the other way."""
    point = np.rint(x)
    odd = np.flatnonzero(point.sum(axis=1) % 2)
    off = x[odd] - point[odd]
    worst = np.abs(off).argmax(axis=1)
    point[odd, worst] += np.where(off[np.arange(len(odd)), worst] < 0, -1.0, 1.0)
    return point


def e8_point(x: np.ndarray) -> np.ndarray:
    """The nearest E8 points: of the even integer points and those shifted by a half."""
    whole, half = _even_point(x), _even_point(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def cells(units: np.ndarray, table: int, scale: float = SCALE, probes: int = PROBES) -> np.ndarray:
    """Of each vector its cell, and its neighbouring cells in order of distance: doubled lattice points."""
    random = np.random.default_rng([SEED, table, units.shape[1]]).standard_normal((units.shape[1], 8))
    # One row at a time gives the same sums for any batch.
    x = np.einsum("ij,jk->ik", units, random) / scale
    home = e8_point(x)
    around = np.argsort(-(x - home) @ ROOTS.T, axis=1, kind="stable")[:, :probes]
    points = np.concatenate([home[:, None], home[:, None] + ROOTS[around]], axis=1)
    return np.rint(2 * points).astype(np.int16)


def _cell_rows(tables: int, scale: float, probes: int):
    def rows(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                ids, labels = part.column("id").to_numpy(), part.column("label")
                vectors = part.column("vector")
                sizes = np.diff(vectors.offsets.to_numpy())
                values = vectors.flatten().to_numpy()
                ends = np.cumsum(sizes)
                for dimension in np.unique(sizes):
                    of = np.flatnonzero(sizes == dimension)
                    dense = np.stack([values[ends[i] - dimension:ends[i]] for i in of])
                    units = dense / np.sqrt((dense * dense).sum(axis=1))[:, None]
                    for table in range(tables):
                        found = cells(units, table, scale, probes)
                        n = len(of) * (probes + 1)
                        home = np.zeros((len(of), probes + 1), dtype=bool)
                        home[:, 0] = True
                        repeated = np.repeat(of, probes + 1)
                        # A hash of a cell; two cells that share one only add candidates.
                        halves = np.ascontiguousarray(found).view("<u8").reshape(n, 2)
                        hashed = (halves[:, 0] * _MIX ^ halves[:, 1]) * _MIX
                        yield pa.RecordBatch.from_arrays([
                            pa.array(ids[repeated]), labels.take(pa.array(repeated)),
                            pa.array(np.full(n, table * 65536 + dimension), pa.int32()),
                            pa.array((hashed ^ hashed >> np.uint64(29)).view("<i8")),
                            pa.array(home.ravel())], names=["id", "label", "place", "cell", "home"])
    return rows


def _cell_links(buckets: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Links (a, b) that connect, within each cell (``key``), all classes of a label with a cosine of at least ``least``.

    A cell's vectors are a row, or a few if there are very many, and then each two of these
    are one; their cosines are a product of matrices.
    """
    named = classes.select(F.col("class").alias("id"), F.col("label").cast("string").alias("label"), "vector")
    members = buckets.select("key", "id").join(named, "id").select(
        "key", "label", F.size("vector").alias("dimension"), F.struct("id", "vector").alias("row"))
    rows = packed_groups(members, BLOCK_ROWS, "key", "label", "dimension")

    def linked(batches):
        for batch in batches:
            lists = [batch.column(name) for name in ("rows", "others")]
            counts = sum(list_sizes(column) for column in lists)
            starts = np.cumsum(counts) - counts
            ids, vectors = both(lists, "id").to_numpy(), both(lists, "vector")
            sizes = vectors.value_lengths().to_numpy().astype(np.int64)
            values, places = vectors.flatten().to_numpy(), np.cumsum(sizes) - sizes
            none = np.zeros(0, dtype=np.int64)
            found_a, found_b = [none], [none]

            def dense(at):
                taken = values[places[at][:, None] + np.arange(sizes[at[0]])]  # noqa: B023
                return taken, np.sqrt((taken * taken).sum(axis=1))

            # Most cells have two vectors: all those of one dimension at once.
            twos = starts[counts == 2]
            for size in np.unique(sizes[twos]):
                first = twos[sizes[twos] == size]
                (one, norms), (two, other_norms) = dense(first), dense(first + 1)
                near = np.einsum("ij,ij->i", one, two) / (norms * other_norms) >= least
                found_a.append(ids[first[near]])
                found_b.append(ids[first[near] + 1])
            for row in np.flatnonzero(counts > 2):
                at = np.arange(starts[row], starts[row] + counts[row])
                # By id, so that a group that meets in many cells has the same links in each.
                at = at[np.argsort(ids[at], kind="stable")]
                dense_rows, norms = dense(at)
                near = dense_rows @ dense_rows.T / (norms[:, None] * norms[None]) >= least
                np.fill_diagonal(near, False)
                links = np.array(forest(near), dtype=np.int64).reshape(-1, 2)
                found_a.append(ids[at[links[:, 0]]])
                found_b.append(ids[at[links[:, 1]]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found_a)), pa.array(np.concatenate(found_b))], names=["a", "b"])

    return rows.mapInArrow(linked, "a long, b long").distinct()


def _link_counts(members: DataFrame, least: float) -> DataFrame:
    """For every id the sum of ``size`` of the others in its component with a cosine of at least ``least``.

    A component is cut into blocks of about ``BLOCK_ROWS``; each pair of blocks is one row,
    and gives one count per member. No pair of members is a row.
    """
    blocks = members.groupBy("component").agg(F.count("*").alias("n")).where("n > 1")
    blocks = blocks.withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int")).drop("n")
    dealt = members.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    packed = dealt.groupBy("component", "block").agg(
        F.first("blocks").alias("blocks"), F.collect_list(F.struct("id", "size", "vector")).alias("rows"))
    packed = stored(packed, scratch_folder(members.sparkSession, "lattice-blocks"))
    left = packed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = packed.select("component", F.col("block").alias("other"), F.col("rows").alias("others"))
    pairs = left.join(right, ["component", "other"]).select("rows", "others")

    def counted(batches):
        def dense(rows):
            ids, sizes = rows.field("id").to_numpy(), rows.field("size").to_numpy()
            vectors = rows.field("vector").flatten().to_numpy().reshape(len(ids), -1)
            return ids, sizes, vectors, np.sqrt((vectors * vectors).sum(axis=1))

        for batch in batches:
            for row in range(batch.num_rows):
                ids, _, vectors, norms = dense(batch.column("rows")[row].values)
                other_ids, sizes, others, other_norms = dense(batch.column("others")[row].values)
                near = vectors @ others.T / (norms[:, None] * other_norms[None]) >= least
                near &= ids[:, None] != other_ids[None]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(near @ sizes)], names=["id", "linked"])

    counts = pairs.mapInArrow(counted, "id long, linked long")
    return counts.groupBy("id").agg(F.sum("linked").alias("linked"))


def near_duplicates(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label",
                    least: float = LEAST_COSINE, tables: int = TABLES, scale: float = SCALE,
                    probes: int = PROBES) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id and kept.

    Vectors link at a cosine of ``least`` or more if their labels are equal and not null.
    Equal vectors of a label are one class, however many there are. Each class is put in its
    cell of every table and in the neighbouring cells it is nearest to; in a cell that is home
    to one of them, all that meet are verified by cosine, and as many links come out as
    connect them. Links are then counted within components by blocks. Null, zero and not finite vectors, null labels and null ids link
    with nothing. Rows that repeat an id count each; all links of an id are added up.
    """
    spark = vectors.sparkSession
    folder = scratch_folder(spark, "lattice")
    named = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    rows = usable_rows(named.where(F.col("label").isNotNull() & F.col("id").isNotNull()), "vector")
    keyed = rows.withColumn("hash", F.sha2(F.to_json(F.struct("label", "vector")), 256))
    classes = keyed.groupBy("hash").agg(
        F.min("id").alias("class"), F.count("*").alias("size"), F.first("label").alias("label"),
        F.first("vector").alias("vector"))
    classes = stored(classes, f"{folder}/classes")
    table = classes.select(F.col("class").alias("id"), F.col("label").cast("string").alias("label"), "vector")
    found = table.mapInArrow(
        _cell_rows(tables, scale, probes), "id long, label string, place int, cell long, home boolean")
    key = F.xxhash64("label", "place", "cell").alias("key")
    buckets = found.select(key, "id", "home")
    shared = buckets.groupBy("key").agg(
        F.min("id").alias("least"), F.max("id").alias("most"), F.bool_or("home").alias("lived")
    ).where("least < most AND lived").select("key")
    buckets = stored(buckets.join(shared, "key"), f"{folder}/buckets")
    linked = components(stored(_cell_links(buckets, classes, least), f"{folder}/links"))
    members = classes.join(linked.withColumnRenamed("id", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class"))
    members = stored(members.select(F.col("class").alias("id"), "hash", "size", "vector", "component"), f"{folder}/members")
    counts = _link_counts(members, least)
    told = members.join(counts, "id", "left").select(
        "hash", (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component")
    per_row = keyed.select("id", "hash").join(told, "hash").select("id", "n_links", "component")
    alone = named.where(~usable("vector") | F.col("label").isNull() | F.col("id").isNull()).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    out = per_row.unionByName(alone)
    return out.select(F.col("id").alias(id_column), "n_links", F.col("component").alias("component_id"),
                      F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))
