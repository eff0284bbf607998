"""Similarity join of documents by the Jaccard share of their word shingles.

The universe of shingles is dealt by hash into segments. Two sets that are similar enough
differ in at most so many shingles (their bound follows from their sizes), so if the
segments' allowances add up to one more, some segment differs by less than its allowance:
with an allowance of 1 it is equal, with 2 it is equal or one set has one shingle more.
Sets are therefore indexed by their part in each segment, and where the allowance is 2 also
by that part with each one of its shingles left out. Bands of set sizes have segments of
their own; a set is in its own band and in each lower one that a partner may be in.

An empty part says nothing of a set and makes no entry. A few more segments than the
difference asks for make up for that: a set whose parts that are not empty still allow more
than the difference meets every similar set (``_entries`` has the argument). The rare sets
that do not are also indexed by their least shingles, once a band.

Texts that share a passage may meet by it. Sets under a key are therefore first compared by
bitmaps, whose difference is never larger than the sets'; only what these leave is put into
one family and compared shingle by shingle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from linkrank.llm.components import both, components, forest, list_sizes, packed_groups, pairs_of_blocks
from linkrank.llm.shingles import mix, shingle_sets
from linkrank.llm.words import small_batches
from linkrank.operators.skew import copy_to_splits, hot_keys, hot_limit, split_rows
from linkrank.session import scratch_folder, stored

SHINGLE_WORDS = 3
LEAST = Fraction(9, 10)
BAND_GROWTH = Fraction(7, 5)
#: Cost of checking a candidate, in index entries.
CHECK_COST = 20.0
#: What unrelated sets are taken to share when allowances are chosen: one in so many sets has the same passage.
PASSAGE_SHINGLES = 50
PASSAGE_SETS = 100
BATCH_BYTES = 1 << 19
RECENT = 1 << 18
#: Sets and their shingles that are held against each other in one row, and shingles taken at a time.
BLOCK_SETS = 192
BLOCK_MEMBERS = 1 << 20
FILTER_WORDS = 1 << 18
BLOCK_SHINGLES = 1 << 13
#: Sets under one key whose bitmaps are held against each other in one row.
BUCKET_SETS = 4096
#: The last bits of a key are its band's number.
BAND_BITS = 7
#: What tells a set: its fingerprint and size.
_SET = ["f1", "f2", "n_shingles"]


@dataclass(frozen=True)
class Band:
    """Sizes ``low`` to ``high`` of the smaller set, and its segments: the first ``doubles`` allow 2, the others 1."""

    number: int
    low: int
    high: int
    segments: int
    doubles: int


def difference(high: int, least: Fraction) -> int:
    """In how many members two sets may differ if the smaller one has at most ``high``."""
    return math.floor(Fraction(high) * (1 - least) / least)


def _spare(lost: float, need: int) -> int:
    """Allowances to add where this many are lost to thin parts on average: few sets lose more."""
    return min(math.ceil(lost + 3 * math.sqrt(lost)), need // 8 + 1) if need > 1 else 0


def allocate(high: int, low: int, least: Fraction, sets: int) -> tuple[int, int]:
    """Segments and how many of them allow 2, at the least expected cost for ``sets`` sets of a band.

    The allowances add up to the possible difference and 1, and to what the largest sets of
    the band lose to empty and nearly empty parts. Fewer, larger segments that allow 2 cost an
    entry for each shingle that is left out, but two sets that only share a passage seldom
    agree on one; segments that allow 1 cost an entry each. The more sets, the dearer such
    meetings. But for tiny sets no choice costs more than an entry for each shingle.
    """
    need, best = difference(high, least) + 1, None
    steps = max(1, need // 64)
    for doubles in [*range(0, need // 2 + 1, steps), need // 2]:
        least_singles = singles = need - 2 * doubles
        for _ in range(4):
            segments = doubles + singles
            empty = math.exp(-high / segments)
            lost = segments * empty + doubles * empty * (1 + high / segments)
            singles = least_singles + _spare(lost, need)
        segments = doubles + singles
        entries = segments + doubles * low / segments
        if doubles and entries > 0.9 * low + 2:
            continue
        empty = math.exp(-high / segments)
        meet = (singles * empty ** 2 + doubles * (empty * (1 + high / segments)) ** 2) / segments
        cost = entries + CHECK_COST * sets / PASSAGE_SETS * min(1.0, PASSAGE_SHINGLES * meet)
        if best is None or cost < best[0]:
            best = (cost, segments, doubles)
    return best[1], best[2]


def size_bands(largest: int, least: Fraction) -> list[tuple[int, int]]:
    """The bands' sizes, up to the largest set."""
    bands, low = [], 1
    while low <= largest:
        high = max(low, math.floor(low * BAND_GROWTH))
        bands.append((low, high))
        low = high + 1
    return bands


def _key(hashed: np.ndarray, band: Band) -> np.ndarray:
    return hashed >> np.uint64(BAND_BITS) << np.uint64(BAND_BITS) | np.uint64(band.number)


def _entries(hashes: np.ndarray, counts: np.ndarray, bands: list[Band], least: Fraction):
    """Index keys of sets: (number of the set, key).

    Say X's part of a segment has p shingles and the segment allows a. If X and Y differ there
    by less than min(a, p), they have a key in common that is not of an empty part: the part
    itself, or the part of one without one of its shingles. If they share none, they differ by
    min(a, p) or more in every segment. So where X's min(a, p) add up to more than X can differ
    from a similar set, X shares a key with every one. Where they don't, X has its
    ``size - least * size + 1`` least shingles as keys too: a similar set either shares a key
    for its own sake or has these as well, and two similar sets share one of them.
    """
    starts = np.cumsum(counts) - counts
    for band in bands:
        # Partners of sets of this band's sizes have at most high / least.
        chosen = np.flatnonzero((counts >= band.low) & (counts <= math.floor(Fraction(band.high) / least)))
        if not len(chosen):
            continue
        sizes = counts[chosen]
        at = np.repeat(starts[chosen] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        members = hashes[at]
        owner = np.repeat(np.arange(len(chosen)), sizes)
        spread = mix(members, 101 + band.number)
        segment = ((spread >> np.uint64(32)) * np.uint64(band.segments) >> np.uint64(32)).astype(np.int64)
        place = owner * band.segments + segment
        value = mix(members, 100003)
        # Sums modulo 2**64 by halves, which doubles add up exactly.
        n = len(chosen) * band.segments
        low = np.bincount(place, (value & np.uint64(0xFFFFFFFF)).astype(float), n).astype(np.uint64)
        high = np.bincount(place, (value >> np.uint64(32)).astype(float), n).astype(np.uint64)
        part = low + (high << np.uint64(32))
        number = np.arange(n) % band.segments
        salt = mix(number.astype(np.uint64) + np.uint64(band.number << 32), 7)
        filled = np.bincount(place, minlength=n)
        some = np.flatnonzero(filled)
        yield chosen[some // band.segments], _key(mix(part[some] ^ salt[some], 13), band)
        if band.doubles:
            double = (segment < band.doubles) & (filled[place] > 1)
            without = part[place[double]] - value[double]
            yield chosen[owner[double]], _key(mix(without ^ salt[place[double]], 13), band)
        allowed = np.minimum(filled, 1 + (number < band.doubles)).reshape(len(chosen), band.segments).sum(axis=1)
        rest = 1 - least
        thin = np.flatnonzero(allowed <= np.minimum(sizes, band.high) * rest.numerator * least.denominator
                              // (rest.denominator * least.numerator))
        if len(thin):
            each = sizes[thin] + 1 + -sizes[thin] * least.numerator // least.denominator
            at = np.repeat(starts[chosen[thin]] - (np.cumsum(each) - each), each) + np.arange(each.sum())
            yield chosen[np.repeat(thin, each)], _key(mix(hashes[at] ^ np.uint64(band.number + 1), 19), band)


def _fingerprints(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, that do not depend on order."""
    out = []
    bounds = np.concatenate([[0], np.cumsum(counts)])
    for salt in (1, 2):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes, salt + 500), dtype=np.uint64)])
        out.append((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64))
    return out[0], out[1]


def _bitmaps(hashes: np.ndarray, counts: np.ndarray, least: Fraction) -> tuple[np.ndarray, list[list[bytes]]]:
    """Each set's own band, and its bitmap in this and each lower band that it is in.

    A band's bitmaps have as many bits as its largest set has shingles. A bit tells whether an
    odd number of shingles hash to it, so two sets' bitmaps differ in at most as many bits as
    the sets differ in shingles.
    """
    sizes = size_bands(int(counts.max(initial=0)), least)
    own = np.searchsorted([low for low, _ in sizes], counts, side="right") - 1
    starts, out = np.cumsum(counts) - counts, [[] for _ in counts]
    # From the highest band down: a set's own comes first.
    for number, (low, high) in reversed(list(enumerate(sizes))):
        chosen = np.flatnonzero((counts >= low) & (counts <= math.floor(Fraction(high) / least)))
        if not len(chosen):
            continue
        each, bits = counts[chosen], 64 * -(-high // 64)
        at = np.repeat(starts[chosen] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        bit = (mix(hashes[at], 301 + number) % np.uint64(bits)).astype(np.int64)
        odd = np.bincount(np.repeat(np.arange(len(chosen)), each) * bits + bit, minlength=len(chosen) * bits) & 1
        packed = np.packbits(odd.astype(bool).reshape(len(chosen), bits), axis=1)
        for i, row in zip(chosen.tolist(), packed, strict=True):
            out[i].append(row.tobytes())
    return own, out


def document_sets(docs: DataFrame, words: int = SHINGLE_WORDS, least: Fraction = LEAST) -> DataFrame:
    """doc_id, n_shingles, the set's fingerprint (f1, f2), its band and bitmaps of every row."""
    def sets(batches):
        for batch in small_batches(batches, "text", BATCH_BYTES):
            hashes, counts = shingle_sets(batch.column("text").to_pylist(), words)
            f1, f2 = _fingerprints(hashes, counts)
            own, bitmaps = _bitmaps(hashes, counts, least)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.array(f1), pa.array(f2), pa.array(own, pa.int32()),
                 pa.array(bitmaps, pa.list_(pa.binary()))],
                names=["doc_id", "n_shingles", "f1", "f2", "band", "bitmaps"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        sets, "doc_id long, n_shingles long, f1 long, f2 long, band int, bitmaps array<binary>")


def _index(docs: DataFrame, words: int, bands: list[Band], least: Fraction) -> DataFrame:
    """Index entries (key, f1) of the sets; a task gives those of equal sets it sees in a row once.

    Half of the fingerprint tells sets under a key apart.
    """
    def entries(batches):
        recent: set[tuple[int, int]] = set()
        for batch in small_batches(batches, "text", BATCH_BYTES):
            hashes, counts = shingle_sets(batch.column("text").to_pylist(), words)
            f1, f2 = _fingerprints(hashes, counts)
            if len(recent) > RECENT:
                recent.clear()
            new = np.zeros(len(counts), dtype=bool)
            for i, print_ in enumerate(zip(f1.tolist(), f2.tolist(), strict=True)):
                if counts[i] and print_ not in recent:
                    recent.add(print_)
                    new[i] = True
            hashes, f1, counts = hashes[np.repeat(new, counts)], f1[new], counts[new]
            for of, keys in _entries(hashes, counts, bands, least):
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(f1[of])], names=["key", "f1"])

    return docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(entries, "key long, f1 long")


def _bitmap_forest(sizes: np.ndarray, maps: np.ndarray, apart: int, whole: int) -> list[tuple[int, int]]:
    """Links that connect all of these sets that may be similar.

    A set found is held against those not yet found only, so a group of near copies costs
    about as many comparisons as it has members.
    """
    left, out = np.arange(len(sizes)), []
    todo: list[int] = []
    while len(left):
        if not todo:
            todo, left = [int(left[0])], left[1:]
        at = todo.pop()
        near = _may_be_similar(sizes[at], sizes[left], maps[at], maps[left], apart, whole)
        out += [(at, int(other)) for other in left[near]]
        todo += left[near].tolist()
        left = left[~near]
    return out


def _may_be_similar(size, sizes: np.ndarray, bits: np.ndarray, maps: np.ndarray, apart: int, whole: int) -> np.ndarray:
    """Whether bitmaps and sizes differ by at most ``apart`` / ``whole`` of the shingles of both sets."""
    differ = np.bitwise_count(maps ^ bits).sum(axis=1, dtype=np.int64)
    return np.maximum(differ, np.abs(sizes - size)) * whole <= (sizes + size) * apart


def _near_links(buckets: DataFrame, classes: DataFrame, least: Fraction) -> DataFrame:
    """Links (a, b) that connect, within each key of ``buckets`` (key, id), all classes that may be similar.

    Similar sets A and B differ in at most (1 - least) / (1 + least) of |A| + |B| shingles, and
    their bitmaps in no more. A key's sets are a row, or a few if there are very many, and then
    each two of these are one.
    """
    nth = F.col("band") - F.col("key").bitwiseAND(F.lit((1 << BAND_BITS) - 1)) + 1
    members = buckets.join(classes.select(F.col("class").alias("id"), "n_shingles", "band", "bitmaps"), "id").select(
        "key", F.struct("id", F.col("n_shingles").alias("size"), F.element_at("bitmaps", nth.cast("int")).alias("bits")).alias("row"))
    rows = packed_groups(members, BUCKET_SETS, "key")
    least = Fraction(least)
    apart, whole = least.denominator - least.numerator, least.denominator + least.numerator

    def linked(batches):
        for batch in batches:
            found_a, found_b = [], []
            lists = [batch.column(name) for name in ("rows", "others")]
            ids, sizes, bits = (both(lists, name) for name in ("id", "size", "bits"))
            ids, sizes = ids.to_numpy(), sizes.to_numpy()
            lengths = pa.compute.binary_length(bits).to_numpy().astype(np.int64)
            raw = np.frombuffer(b"".join(bits.to_pylist()), dtype="u1")
            places = np.cumsum(lengths) - lengths
            counts = sum(list_sizes(column) for column in lists)
            starts = np.cumsum(counts) - counts

            def maps(rows):
                at = places[rows][:, None] + np.arange(lengths[rows[0]])  # noqa: B023
                return raw[at].view("<u8")  # noqa: B023

            # Most keys have two sets: all those of one band at once.
            twos = starts[counts == 2]
            for length in np.unique(lengths[twos]):
                first = twos[lengths[twos] == length]
                near = _may_be_similar(sizes[first], sizes[first + 1], maps(first), maps(first + 1), apart, whole)
                found_a.append(ids[first[near]])
                found_b.append(ids[first[near] + 1])
            for row in np.flatnonzero(counts > 2):
                rows = np.arange(starts[row], starts[row] + counts[row])
                # By id, so that a group that meets under many keys has the same links under each.
                rows = rows[np.argsort(ids[rows], kind="stable")]
                links = np.array(_bitmap_forest(sizes[rows], maps(rows), apart, whole), dtype=np.int64).reshape(-1, 2)
                found_a.append(ids[rows[links[:, 0]]])
                found_b.append(ids[rows[links[:, 1]]])
            none = np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([none, *found_a])), pa.array(np.concatenate([none, *found_b]))], names=["a", "b"])

    return rows.mapInArrow(linked, "a long, b long").distinct()


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two of the sets share: products of slices of their incidence matrix."""
    values, number = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = np.bincount(number, minlength=len(values)) > 1
    column = (np.cumsum(shared) - 1)[number]
    held = shared[number]
    owner, column = owner[held], column[held]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for start in range(0, int(shared.sum()), BLOCK_SHINGLES):
        a, b = np.searchsorted(column, [start, start + BLOCK_SHINGLES])
        part = np.zeros((len(sets), BLOCK_SHINGLES), dtype=np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        total += part @ part.T
    return total.astype(np.int64)


def _families(links: DataFrame, classes: DataFrame) -> DataFrame:
    """The family (component) of every class in ``links`` (a, b), and its block of the family.

    Blocks hold about ``BLOCK_SETS`` sets and ``BLOCK_MEMBERS`` shingles.
    """
    families = components(links).join(classes.withColumnRenamed("class", "id"), "id")
    sizes = families.groupBy("component").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n_shingles") / BLOCK_MEMBERS)).cast("int").alias("blocks"))
    dealt = families.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    return dealt.drop("n_shingles")


def _possible(rows: DataFrame, wanted: DataFrame, of: str) -> DataFrame:
    """The rows of ``rows`` whose ``of`` may be one of ``wanted``'s: a bit each in a table of fixed size.

    The table (``FILTER_WORDS`` rows of 64 bits at most) is broadcast. Others that share a bit
    pass too, so the join that follows decides; it only has fewer texts to move.
    """
    place = F.pmod(F.xxhash64(of), F.lit(64 * FILTER_WORDS))
    word, bit = F.shiftright("__place", 6).alias("__word"), F.col("__place") % 64
    marked = wanted.select(place.alias("__place")).select(word, bit.cast("int").alias("__bit"))
    table = marked.groupBy("__word").agg(F.expr("bit_or(shiftleft(1L, __bit))").alias("__bits"))
    placed = rows.withColumn("__place", place).select("*", word)
    return placed.join(F.broadcast(table), "__word").where(F.getbit("__bits", bit) == 1).select(*rows.columns)


def _packed_sets(docs: DataFrame, families: DataFrame, words: int) -> DataFrame:
    """A row per block of a family, with the shingles of its sets.

    A class is read from the rows of its document ``doc``. Texts meet their families once, as
    texts, which are smaller than their shingles. A row whose set is not its class's is left
    out, and one that repeats another in its task too.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    texts = _possible(rows, families, "doc").join(families, "doc")

    def sets(batches):
        recent: set[int] = set()
        for batch in small_batches(batches, "text", BATCH_BYTES):
            hashes, counts = shingle_sets(batch.column("text").to_pylist(), words)
            f1, f2 = _fingerprints(hashes, counts)
            wanted = (f1 == batch.column("f1").to_numpy()) & (f2 == batch.column("f2").to_numpy())
            if len(recent) > RECENT:
                recent.clear()
            ids = batch.column("id").to_pylist()
            for i in np.flatnonzero(wanted).tolist():
                wanted[i] = ids[i] not in recent
                recent.add(ids[i])
            ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            shingles = pa.ListArray.from_arrays(ends, pa.array(hashes.view(np.int64)))
            kept = [batch.column(name) for name in ("component", "block", "blocks", "id")]
            yield pa.RecordBatch.from_arrays(
                [*kept, shingles], names=["component", "block", "blocks", "id", "shingles"]).filter(pa.array(wanted))

    found = texts.select("component", "block", "blocks", "id", "f1", "f2", "text").mapInArrow(
        sets, "component long, block int, blocks int, id long, shingles array<long>")
    return found.groupBy("component", "block").agg(
        F.first("blocks").alias("blocks"), F.collect_list(F.struct("id", "shingles")).alias("rows"))


def _family_links(packed: DataFrame, least: Fraction) -> DataFrame:
    """Links (a, b) that connect all sets of a family that are similar.

    A block, or two blocks of a family, are a row, in which every two of their sets are
    compared and as many links come out as connect them. So no two sets are a row of their
    own, however large a group of near copies is. Only families of several blocks are joined.
    """
    pairs = pairs_of_blocks(packed, "component")
    number, of = least.numerator, least.denominator

    def linked(batches):
        for batch in batches:
            found = []
            for row in range(batch.num_rows):
                blocks = [batch.column(name)[row].values for name in ("rows", "others") if batch.column(name)[row].is_valid]
                ids = np.concatenate([block.field("id").to_numpy() for block in blocks])
                sets = [s.values.to_numpy() for block in blocks for s in block.field("shingles")]
                sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
                common = _common(sets)
                near = common * of >= (sizes[:, None] + sizes[None] - common) * number
                np.fill_diagonal(near, False)
                order = np.argsort(ids, kind="stable")
                ids, near = ids[order], near[order][:, order]
                found += [(int(ids[i]), int(ids[j])) for i, j in forest(near)]
            yield pa.RecordBatch.from_pydict({
                "a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return pairs.mapInArrow(linked, "a long, b long")


def _linkable():
    return F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)


def _grouped_sets(docs: DataFrame, words: int, least: Fraction, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All rows' sets (doc_id, n_shingles, f1, f2); the classes of equal sets; links (a, b) between classes.

    Classes have a number (``class``), their smallest doc_id (``doc``) and how many rows they
    have (``size``). Rows without doc_id and empty sets are in none.
    """
    sets = stored(document_sets(docs, words, least), f"{folder}/sets")
    classes = sets.where(_linkable()).groupBy(*_SET).agg(
        F.min("doc_id").alias("doc"), F.count("*").alias("size"), F.first("band").alias("band"), F.first("bitmaps").alias("bitmaps"))
    # Numbers are given once, in a table: later jobs read them and do not give them anew.
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), f"{folder}/classes")
    largest = classes.agg(F.max("n_shingles")).first()[0] or 0
    sizes = size_bands(largest, least)
    # A count per band of sizes: a few dozen.
    steps = F.array(*[F.lit(low) for low, _ in sizes]) if sizes else F.array()
    of_band = F.size(F.filter(steps, lambda low: low <= F.col("n_shingles"))) - 1
    counts = {row.band: row["count"] for row in classes.groupBy(of_band.alias("band")).count().collect()}
    bands = [Band(i, low, high, *allocate(high, low, least, counts.get(i, 0)))
             for i, (low, high) in enumerate(sizes) if counts.get(i) or counts.get(i + 1)]

    index = _index(docs, words, bands, least)
    line = Window.partitionBy("key").orderBy("f1")
    differs = lambda step: F.coalesce(F.lag("f1", step).over(line) != F.col("f1"), F.lit(False))
    met = index.withColumn("met", differs(1) | differs(-1)).where("met").select("key", "f1").distinct()
    buckets = stored(met.join(classes, "f1").select("key", F.col("class").alias("id")), f"{folder}/buckets")

    near = stored(_near_links(buckets, classes, least), f"{folder}/near")
    facts = classes.drop("band", "bitmaps", "size")
    families = stored(_families(near, facts), f"{folder}/families")
    packed = stored(_packed_sets(docs, families, words), f"{folder}/packed")
    links = stored(_family_links(packed, least), f"{folder}/links")
    return sets.drop("band", "bitmaps"), classes.drop("band", "bitmaps"), links


def _grouped(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` with the ``group`` that each is in: the least number reachable by links."""
    linked = components(links).withColumnRenamed("id", "class").withColumnRenamed("component", "group")
    return classes.join(linked, "class", "left").withColumn("group", F.coalesce("group", "class"))


def _of_rows(sets: DataFrame, told: DataFrame) -> DataFrame:
    """The rows of ``sets`` that are in a class, with what ``told`` says of it; a class of very many rows is split."""
    limit = hot_limit(sets.count())
    hot = hot_keys(told.select(*_SET, "size"), "size", limit)
    splits = F.greatest(F.ceil(F.col("size") / F.lit(limit)), F.lit(1)).cast("int")
    copies = copy_to_splits(told.withColumn("splits", splits)).drop("size")
    return split_rows(sets.where(_linkable()), _SET, "doc_id", hot).join(copies, [*_SET, "split"]).drop("split")


def similar_documents(docs: DataFrame, words: int = SHINGLE_WORDS, least: Fraction = LEAST) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every row.

    Two documents link if their shingles' intersection is at least ``least`` of their union.
    Equal sets are one class from the start. Bands' segments follow from counts of all sets.
    Entries are sorted by key, and only keys with several classes go on; of the sets that
    meet, those whose bitmaps allow it are compared on all their shingles, block by block.

    Words are split at ASCII white space, A-Z in lower case. Null and empty texts and texts
    without words have no shingles and link with nothing, like rows without doc_id (their
    component is null). Rows that repeat a doc_id with other texts are one document that has
    all links of its texts; each row tells its own number of shingles.
    """
    least = Fraction(least)
    folder = scratch_folder(docs.sparkSession, "jaccard")
    sets, classes, links = _grouped_sets(docs, words, least, folder)
    # Documents with several sets: their classes hang together, each by the least of them.
    named = sets.where(F.col("doc_id").isNotNull())
    several = named.groupBy("doc_id").agg(
        F.min(F.struct(*_SET)).alias("low"), F.max(F.struct(*_SET)).alias("high")).where("low <> high").select("doc_id")
    several = stored(several, f"{folder}/several")
    some = not several.isEmpty()
    if some:
        mine = named.join(several, "doc_id").select("doc_id", *_SET).distinct().join(classes, _SET).select("doc_id", "class")
        first = mine.groupBy("doc_id").agg(F.min("class").alias("a"))
        links = links.union(mine.join(first, "doc_id").select("a", F.col("class").alias("b")))
    told = _grouped(classes, links)
    smallest = told.groupBy("group").agg(F.min("doc").alias("component_id"))
    rows = _of_rows(sets, told.join(smallest, "group").select(*_SET, "size", "component_id"))
    rows = rows.select("doc_id", "n_shingles", "component_id")
    alone = sets.where(~_linkable()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    if some:
        # An empty text of a document that has others is where they are.
        others = rows.join(several, "doc_id").groupBy("doc_id").agg(F.min("component_id").alias("other"))
        alone = alone.join(others, "doc_id", "left").select(
            "doc_id", "n_shingles", F.coalesce("other", "component_id").alias("component_id"))
    return rows.unionByName(alone)


def keep_one_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, least: Fraction = LEAST) -> DataFrame:
    """Of each group of similar rows the one with the smallest doc_id, with the columns they had.

    Rows are judged by their own texts, also where they repeat a doc_id; of rows that repeat
    the doc_id and the set of shingles of the one that stays, one is left. Rows without
    doc_id, and with texts that link with nothing, stay.
    """
    least = Fraction(least)
    folder = scratch_folder(docs.sparkSession, "jaccard")
    sets, classes, links = _grouped_sets(docs, words, least, folder)
    told = _grouped(classes, links)
    best = told.groupBy("group").agg(F.min(F.struct("doc", "class")).alias("best"))
    told = told.join(best, "group").select(
        *_SET, "size", F.when(F.col("class") == F.col("best.class"), F.col("doc")).alias("keep_id"))
    rows = _of_rows(sets, told).select("doc_id", "f1", "f2", (F.col("keep_id") == F.col("doc_id")).alias("stays"))
    empty = sets.where((F.col("n_shingles") == 0) & F.col("doc_id").isNotNull())
    rows = rows.unionByName(empty.select("doc_id", "f1", "f2", F.lit(True).alias("stays")))
    judged = rows.groupBy("doc_id").agg(F.count("*").alias("rows"), F.count_if("stays").alias("staying"))
    judged = stored(judged.where("rows > 1 OR staying = 0"), f"{folder}/judged")
    kept = docs.join(judged.select(F.col("doc_id").alias("__id")), docs["doc_id"] == F.col("__id"), "left_anti")
    repeated = judged.where("staying > 0").select(F.col("doc_id").alias("__id"))
    if repeated.isEmpty():
        return kept
    # A doc_id of several rows of which some stay: which ones, their texts decide.
    staying = rows.where("stays").join(repeated, F.col("doc_id") == F.col("__id")).select(
        "__id", F.col("f1").alias("__f1"), F.col("f2").alias("__f2")).distinct()
    marked = _with_prints(docs.join(repeated, docs["doc_id"] == F.col("__id"), "left_semi"), words)
    marked = marked.join(staying, (marked["doc_id"] == F.col("__id")) & (marked["__f1"] == staying["__f1"])
                         & (marked["__f2"] == staying["__f2"]), "left_semi")
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    once = marked.where("__n > 0").groupBy("doc_id", "__f1", "__f2").agg(
        F.min_by(row, F.xxhash64(F.to_json(row))).alias("row")).select("row.*")
    return kept.unionByName(once).unionByName(marked.where("__n = 0").select(*docs.columns))


def _with_prints(docs: DataFrame, words: int) -> DataFrame:
    """``docs`` with their sets' fingerprints ``__f1``, ``__f2`` and sizes ``__n``."""
    def printed(batches):
        for batch in small_batches(batches, "text", BATCH_BYTES):
            hashes, counts = shingle_sets(batch.column("text").to_pylist(), words)
            f1, f2 = _fingerprints(hashes, counts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(f1), pa.array(f2), pa.array(counts)],
                names=[*batch.schema.names, "__f1", "__f2", "__n"])

    schema = StructType([*docs.schema.fields, *(StructField(name, LongType()) for name in ("__f1", "__f2", "__n"))])
    return docs.mapInArrow(printed, schema)
