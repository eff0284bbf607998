"""The prefix trie of conversations: who shares which beginning, and what sharing saves."""

from __future__ import annotations

import hashlib
import math
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkrank.llm.perfect_hash import PerfectHash
from linkrank.operators.skew import hot_limit
from linkrank.session import scratch_folder, stored

#: Conversations borrow their first turns from the one at the start of their group of so many.
GROUP = 5
#: How many they borrow is a hash modulo this.
HEADS = 9
#: Nodes with more members than this, or a ten-thousandth of all rows, are above the shards.
SHARD_MEMBERS = 100_000
#: Segments that a shard has on average.
SHARD_SEGMENTS = 200_000
_ROOT = bytes(16)
_NODE = ["d1", "d2"]
_PARENT = ["p1", "p2"]
_EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, position (from 1), what (a digest of role and text) and bytes (of the text) of every turn.

    Turns stand in the order of ``turn``, null first; those that tie in the order of their
    digests. A null role or text is empty. Rows without conv_id are left out.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    named = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("what"),
        F.octet_length(text).cast("long").alias("bytes"))
    line = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "what")
    return named.select("conv_id", F.row_number().over(line).cast("long").alias("position"), "what", "bytes")


def with_borrowed_heads(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: (turns with their new position and the conversation's length, conv_id and length of each).

    Conversation c begins with the first h turns of conversation c - c % ``group`` (all if it
    has fewer, none if there is none), h being crc32 of c in decimals modulo ``heads``; what
    follows its own first h turns comes after. One may be left without turns.
    """
    own = turns.groupBy("conv_id").agg(F.max("position").alias("own"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h")
    asking = own.select("conv_id", "own", h, (F.col("conv_id") - F.col("conv_id") % group).alias("donor"))
    given = own.select(F.col("conv_id").alias("donor"), F.col("own").alias("given"))
    used = F.least("h", F.coalesce("given", F.lit(0)))
    rebuilt = asking.join(given, "donor", "left").withColumn("used", used).withColumn(
        "length", F.col("used") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).drop("own", "given")
    rebuilt = stored(rebuilt, scratch_folder(turns.sparkSession, "rebuilt"))
    kept = turns.join(rebuilt, "conv_id").where("position > h").select(
        "conv_id", (F.col("position") - F.col("h") + F.col("used")).alias("position"), "length", "what", "bytes")
    first = turns.where(F.col("position") < heads).withColumnRenamed("conv_id", "donor")
    borrowed = first.join(rebuilt, "donor").where("position <= h").select("conv_id", "position", "length", "what", "bytes")
    return kept.unionByName(borrowed), rebuilt.select("conv_id", "length")


def _prefixes(turns: DataFrame) -> DataFrame:
    """Every turn as the node it leads to: a digest of its prefix, chained along the conversation, and its parent's."""
    def chained(batches):
        # A conversation may go on in the next batch.
        now, digest = None, _ROOT
        for batch in batches:
            below, above = [], []
            for conversation, what in zip(batch.column("conv_id").to_pylist(), batch.column("what").to_pylist(), strict=True):
                if conversation != now:
                    now, digest = conversation, _ROOT
                above.append(digest)
                digest = hashlib.blake2b(digest + what, digest_size=16).digest()
                below.append(digest)
            pairs = [np.frombuffer(b"".join(part), dtype="<i8").reshape(-1, 2) for part in (below, above)]
            last = pa.compute.equal(batch.column("position"), batch.column("length"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("position"),
                 *(pa.array(np.ascontiguousarray(pair[:, i])) for pair in pairs for i in (0, 1)), batch.column("bytes"), last],
                names=["conv_id", "depth", *_NODE, *_PARENT, "bytes", "last"])

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return ordered.select("conv_id", "position", "length", "what", "bytes").mapInArrow(
        chained, "conv_id long, depth long, d1 long, d2 long, p1 long, p2 long, bytes long, last boolean")


def _nodes(rows: DataFrame) -> DataFrame:
    """A row per distinct prefix. Prefixes of one digest must agree in depth, parent and bytes, or the job fails."""
    facts = ["depth", *_PARENT, "bytes"]
    found = rows.groupBy(*_NODE).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.count_if("last").alias("ends"),
        *(F.min(name).alias(name) for name in facts), *(F.max(name).alias(f"{name}_") for name in facts))
    agree = F.lit(True)
    for name in facts:
        agree = agree & F.col(name).eqNullSafe(F.col(f"{name}_"))
    checked = F.when(agree, F.col("conv_id")).otherwise(F.raise_error(F.lit("two prefixes have one digest")).cast("long"))
    return found.withColumn("conv_id", checked).drop(*(f"{name}_" for name in facts))


def subtree_sums(digests: np.ndarray, parents: np.ndarray, depths: np.ndarray, *values: np.ndarray):
    """Sums of each value over each node's subtree, and which nodes have their parent elsewhere.

    Nodes get slots of a minimal perfect hash; their values are scattered into flat arrays by
    slot, and added to the parents' slots from the deepest nodes up.
    """
    table = PerfectHash(digests)
    slot = table.find(digests)
    up = np.empty(len(slot), dtype=np.int64)
    up[slot] = table.find(parents)
    sums = []
    for value in values:
        flat = np.zeros(len(slot), dtype=np.int64)
        flat[slot] = value
        sums.append(flat)
    order = np.argsort(-depths, kind="stable")
    ends = np.flatnonzero(np.diff(depths[order], append=-1)) + 1
    for start, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
        level = slot[order[start:end]]
        level = level[up[level] >= 0]
        for flat in sums:
            np.add.at(flat, up[level], flat[level])
    return [flat[slot] for flat in sums], up[slot] < 0


def _accumulated(segments: DataFrame, *by: str) -> DataFrame:
    """Segments with ``leaves`` and ``saved`` summed over their subtrees within each group; heads' parents are outside."""
    def summed(table: pa.Table) -> pa.Table:
        column = lambda name: table.column(name).to_numpy().astype(np.int64)
        digests, parents = (np.stack([column(a), column(b)], axis=1).view(np.uint64) for a, b in (_NODE, _PARENT))
        (leaves, saved), heads = subtree_sums(digests, parents, column("depth"), column("leaves"), column("saved"))
        kept = [table.column(name) for name in (*_NODE, *_PARENT, "conv_id", "n_convs")]
        return pa.table([*kept, pa.array(leaves), pa.array(saved), pa.array(heads)],
                        names=[*_NODE, *_PARENT, "conv_id", "n_convs", "leaves", "saved", "head"])

    return segments.groupBy(*by).applyInArrow(
        summed, "d1 long, d2 long, p1 long, p2 long, conv_id long, n_convs long, leaves long, saved long, head boolean")


def _ends(rows: DataFrame) -> DataFrame:
    """For each node where conversations end, the SHA-256 of their ids, ascending and comma-joined.

    A hash takes its bytes in order, so a node's ids go through one task, as a sorted stream
    that is never held.
    """
    def hashed(batches):
        now, digest = None, None
        for batch in batches:
            done = []
            numbers = [batch.column(name).to_pylist() for name in (*_NODE, "conv_id")]
            for node, group in groupby(zip(*numbers, strict=True), key=lambda row: row[:2]):
                part = ",".join(str(row[2]) for row in group).encode()
                if node == now:
                    digest.update(b"," + part)
                    continue
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = node, hashlib.sha256(part)
            yield _hash_rows(done)
        if now is not None:
            yield _hash_rows([(*now, digest.hexdigest())])

    ending = rows.where("last").select(*_NODE, "conv_id")
    return ending.repartition(*_NODE).sortWithinPartitions(*_NODE, "conv_id").mapInArrow(
        hashed, "d1 long, d2 long, ends_sha256 string")


def _hash_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
        names=[*_NODE, "ends_sha256"])


def prefix_trie(turns: DataFrame, lengths: DataFrame, shard_members: int = SHARD_MEMBERS,
                shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """A row per node of the trie of conversations: what ``conversation_nodes`` returns.

    ``turns`` has conv_id, position, length, what and bytes; ``lengths`` every conv_id, those
    without turns too, and its length.

    A prefix is known by a digest chained along its turns; digests are counted, and a node's
    facts checked, in tasks first. A node with one member has all it needs in itself. Others
    with the same members, one below the other, make a segment, so the tree of segments has at
    most twice as many as there are conversations, however long these are. Segments of more
    than ``shard_members`` members (or a ten-thousandth of all rows) are fewer than 10,000;
    the subtrees below them, none of which has more members than that, are dealt to shards. In
    a shard, segments are slots of a minimal perfect hash table and sums run up its
    parent slots; the top is a shard of its own, which gets the others' sums.
    """
    folder = scratch_folder(turns.sparkSession, "trie")
    root = np.frombuffer(_ROOT, "<i8").tolist()
    tops = lengths.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), *(F.lit(root[i]).cast("long").alias(name) for i, name in enumerate(_NODE)),
        *(F.lit(None).cast("long").alias(name) for name in _PARENT), F.lit(0).cast("long").alias("bytes"),
        (F.col("length") == 0).alias("last"))
    rows = stored(_prefixes(turns).unionByName(tops), f"{folder}/rows")
    nodes = stored(_nodes(rows), f"{folder}/nodes")
    shared = nodes.where("n_convs > 1 OR depth = 0")
    children = nodes.where("depth > 0").groupBy(*_PARENT).agg(
        F.count("*").alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("single"))
    children = stored(children.toDF(*_NODE, "n_children", "single"), f"{folder}/children")

    segments = shared.groupBy("conv_id", "n_convs").agg(
        F.max("depth").alias("depth"), *(F.max_by(name, "depth").alias(name) for name in _NODE),
        *(F.min_by(name, "depth").alias(name) for name in _PARENT), F.sum("bytes").alias("bytes"))
    childless = F.col("n_children").isNull()
    segments = segments.join(children, _NODE, "left").select(
        "conv_id", "n_convs", "depth", *_NODE, *(F.coalesce(name, F.lit(-1)).cast("long").alias(name) for name in _PARENT),
        F.when(childless, 1).otherwise(F.col("single")).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    segments = stored(segments, f"{folder}/segments")

    # Each node above the shards has more than ``limit`` rows, so there are fewer than 10,000.
    limit = hot_limit(rows.count(), shard_members)
    is_top = (F.col("n_convs") > limit) | (F.col("depth") == 0)
    top_nodes = nodes.where(is_top)
    above = F.broadcast(top_nodes.select(*_NODE))
    heads = rows.join(above, _NODE, "left_anti").groupBy("conv_id").agg(
        F.min_by("d1", "depth").alias("h1"), F.min_by("d2", "depth").alias("h2"))
    # The root's segment is on top even if few members reach its end.
    held = segments.join(F.broadcast(top_nodes.select("conv_id", "n_convs").distinct()), ["conv_id", "n_convs"], "left_semi")
    rest = segments.join(F.broadcast(top_nodes.select("conv_id", "n_convs").distinct()), ["conv_id", "n_convs"], "left_anti")
    shards = max(1, math.ceil(segments.count() / shard_segments))
    dealt = rest.join(heads, "conv_id").withColumn("shard", F.pmod(F.xxhash64("h1", "h2"), F.lit(shards)).cast("int"))
    low = stored(_accumulated(dealt, "shard"), f"{folder}/shards")
    given = low.where("head").groupBy(*_PARENT).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    held = held.join(given.toDF(*_NODE, "more_leaves", "more_saved"), _NODE, "left").select(
        "conv_id", "n_convs", "depth", *_NODE, *_PARENT,
        *((F.col(name) + F.coalesce(f"more_{name}", F.lit(0))).alias(name) for name in ("leaves", "saved")),
        F.lit(0).alias("shard"))
    sums = low.unionByName(_accumulated(held, "shard")).select("conv_id", "n_convs", "leaves", "saved")
    sums = stored(sums, f"{folder}/sums")

    # A segment's saving less that of its nodes above.
    before = Window.partitionBy("conv_id", "n_convs").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    spent = (F.col("n_convs") - 1) * F.coalesce(F.sum("bytes").over(before), F.lit(0))
    full = shared.withColumn("spent", spent).join(sums, ["conv_id", "n_convs"]).join(children, _NODE, "left").select(
        *_NODE, *_PARENT, "conv_id", "depth", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("saved") - F.col("spent")).alias("saved_tokens"), "ends")
    single = nodes.where("n_convs = 1 AND depth > 0").select(
        *_NODE, *_PARENT, "conv_id", "depth", "n_convs", (1 - F.col("ends")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), "ends")
    every = full.unionByName(single)

    # Parents on top have many children: they are broadcast, the others joined.
    parent = lambda table: table.select(
        F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    below_top = every.join(F.broadcast(parent(top_nodes)), _PARENT)
    deeper = every.where("depth > 0").join(F.broadcast(parent(top_nodes)), _PARENT, "left_anti").join(
        parent(nodes.where(~is_top & (F.col("n_convs") > 1))), _PARENT, "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "conv_id"))
    first = every.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    named = first.unionByName(below_top).unionByName(deeper)
    ending = named.where("ends > 0").join(_ends(rows), _NODE)
    going = named.where("ends = 0").withColumn("ends_sha256", F.lit(_EMPTY_SHA256))
    return ending.unionByName(going).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def conversation_nodes(conversations: DataFrame, shard_members: int = SHARD_MEMBERS,
                       shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node.

    Conversations are rebuilt (``with_borrowed_heads``); a node is a sequence of first turns
    (role and text) that some of them share, from the root without any. ``conv_id`` is its
    smallest member; ``n_leaves`` counts childless nodes in its subtree, itself included;
    ``saved_tokens`` adds up, over its subtree, the bytes of each node's last text for every
    member but one; ``ends_sha256`` is of the members that end here. Nulls and ties are
    defined by ``conversation_turns``; rows repeated in full are turns of their own. An empty
    table has no nodes.
    """
    turns = stored(conversation_turns(conversations), scratch_folder(conversations.sparkSession, "turns"))
    return prefix_trie(*with_borrowed_heads(turns), shard_members, shard_segments)
