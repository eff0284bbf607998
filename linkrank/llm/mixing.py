"""Mixing sources to target weights along a curriculum that changes over training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkrank.llm.text import count_between
from linkrank.session import scratch_folder, stored

GAP = r"[\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = (3, 2)
MAX_PASSES = 2
#: Weight of a class of sources at equally spaced moments of the training, linear in between.
SCHEDULES = ((3.0, 2.0, 1.0), (1.0, 1.0, 1.0), (1.0, 2.0, 3.0))
BUCKET_DIGITS = 3


def _ranked(df: DataFrame, order: Column, folder: str) -> DataFrame:
    """Numbers the rows from 0 by ``order``: ranges in parallel, then one count per range."""
    ranged = df.repartitionByRange(order).sortWithinPartitions(order)
    ranged = stored(ranged.withColumn("__at", F.monotonically_increasing_id()), folder)
    part, row = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = F.broadcast(sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before")))
    return (
        ranged.withColumn("__part", part).join(offsets, "__part")
        .withColumn("rank", F.col("__before") + row).drop("__part", "__before", "__at")
    )


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, max_passes=MAX_PASSES) -> DataFrame:
    """``source``, ``source_size``, ``weight``, ``target`` and ``class`` of sources with their sizes.

    Sources take ``weights`` in turn by code point, null last, and divide ``share`` of all
    words. A source whose part would exceed ``max_passes`` of its size stops there and the
    rest is divided again. Weight times one level is what an uncapped source gets; the level
    only rises, and each turn is one aggregate over the sources. No words, no target: 0.
    """
    folder = scratch_folder(sizes.sparkSession, "sources")
    sizes = stored(sizes, f"{folder}/sizes")
    kinds = len(weights)
    ranked = _ranked(sizes, F.col("source").asc_nulls_last(), f"{folder}/ranked")
    ranked = ranked.withColumn("class", (F.col("rank") % kinds).cast("int"))
    ranked = stored(ranked.withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("class") + 1)), f"{folder}/weighed")
    cap = F.col("source_size") * max_passes
    level, total = None, ranked.agg(F.sum("source_size")).first()[0] or 0
    while total:
        full = F.lit(False) if level is None else cap < F.col("weight") * level
        row = ranked.agg(F.sum(F.when(full, cap)).alias("capped"),
                         F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        if not row.weight:
            break
        new = (total * share[0] / share[1] - (row.capped or 0)) / row.weight
        if level is not None and new <= level:
            break
        level = new
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(float(level or 0)))
    return ranked.withColumn("target", target).drop("rank")


def _inverse_demand(share: Column, kind: Column, schedules) -> Column:
    """The moment (0 to 1) by which a source has asked for ``share`` of its words.

    The weight is linear between knots, so the demand is a square in each piece; the piece
    is found by its demand at the knots.
    """
    moment = F.lit(None).cast("double")
    for number, knots in enumerate(schedules):
        step = 1.0 / (len(knots) - 1)
        areas = [0.0]
        for a, b in zip(knots, knots[1:], strict=False):
            areas.append(areas[-1] + (a + b) / 2 * step)
        wanted = share * areas[-1]
        found = F.lit(1.0)
        for i in range(len(knots) - 2, -1, -1):
            slope, rest = (knots[i + 1] - knots[i]) / step, wanted - F.lit(areas[i])
            root = F.sqrt(F.greatest(F.lit(0.0), F.lit(knots[i] ** 2) + 2 * slope * rest))
            inside = 2 * rest / (F.lit(knots[i]) + root)
            found = F.when(wanted < areas[i + 1], F.lit(i * step) + F.greatest(F.lit(0.0), inside)).otherwise(found)
        moment = F.when(kind == number, found).otherwise(moment)
    return moment


def plan_mix(docs: DataFrame, seed: str = "mix", weights=WEIGHTS, share=SHARE, max_passes=MAX_PASSES,
             schedules=SCHEDULES) -> DataFrame:
    """Every row of ``docs`` with what the mix takes of it, in ``__``-prefixed columns.

    ``__size`` words of the text (null: 0), ``__source_size``, ``__target``, ``__taken`` and
    ``__copies``: for each pass over the source that takes words of this row, ``pass``,
    ``words`` (the text's first so many) and ``position`` (0 to 1).

    Within a source the rows follow md5(seed, doc_id); the source's target is a length of
    that stream, repeated for a second pass, and the last row may be cut, so what is taken
    from a source is its target rounded to a word. A row's position is the moment at which
    the integral of its source's schedule reaches the middle of its words. Weights of
    schedules must be over 0.

    Rows of a source meet only in md5 buckets: the sums over buckets come from a partial
    aggregate, so a source with a third of all rows is spread over 4,096 of them. Rows that
    repeat a doc_id count each. Null text or no word: size 0, nothing taken. An empty table
    gives an empty one. Other columns pass through.
    """
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = docs.withColumn("__size", count_between("text", GAP))
    sized = sized.withColumn("__md5", digest).withColumn("__bucket", F.substring("__md5", 1, BUCKET_DIGITS))
    folder = scratch_folder(docs.sparkSession, "mix")
    sums = stored(sized.groupBy("source", "__bucket").agg(F.sum("__size").alias("__words")), f"{folder}/buckets")
    targets = source_targets(
        sums.groupBy("source").agg(F.sum("__words").alias("source_size")), weights, share, max_passes)
    targets = targets.select(
        F.col("source").alias("__of"), F.col("source_size").alias("__source_size"),
        F.col("target").alias("__target"), F.col("class").alias("__class"))
    earlier = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__base", F.coalesce(F.sum("__words").over(earlier), F.lit(0)))
    sums = sums.join(targets, F.col("source").eqNullSafe(F.col("__of"))).select(
        "__of", F.col("__bucket").alias("__in"), "__base", "__source_size", "__target", "__class")
    before = Window.partitionBy("source", "__bucket").orderBy(
        "__md5", "__size", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, -1)
    rows = sized.withColumn("__prefix", F.coalesce(F.sum("__size").over(before), F.lit(0)))
    rows = rows.join(sums, F.col("source").eqNullSafe(F.col("__of")) & (F.col("__bucket") == F.col("__in")))
    wanted = F.round("__target").cast("long")
    copies = []
    for turn in range(max_passes):
        start = F.lit(turn) * F.col("__source_size") + F.col("__base") + F.col("__prefix")
        words = F.greatest(F.lit(0), F.least(F.col("__size"), wanted - start)).cast("long")
        position = _inverse_demand((start + words / 2) / wanted, F.col("__class"), schedules)
        copies.append(F.when(words > 0, F.struct(
            F.lit(turn).alias("pass"), words.alias("words"), position.alias("position"))))
    rows = rows.withColumn("__copies", F.array_compact(F.array(*copies)))
    taken = F.aggregate("__copies", F.lit(0).cast("long"), lambda total, copy: total + copy["words"])
    return rows.withColumn("__taken", taken).drop("__of", "__in", "__base", "__prefix", "__class", "__bucket")


def _in_order(df: DataFrame, position: str, more: list) -> DataFrame:
    """Range-sorts by a position of 0 to 1: equal slices of the training, one a partition.

    The range of the key is known, so no sample of the rows is drawn. There are as many
    slices as shuffle partitions. Rows without position are dealt over all slices by a hash
    of ``more`` and come last in each.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = F.pmod(F.xxhash64(*more), F.lit(slices))
    number = F.when(F.col(position).isNull(), dealt).otherwise(
        F.least(F.floor(F.col(position) * slices), F.lit(slices - 1))).cast("int")
    return df.repartitionById(slices, number).sortWithinPartitions(F.col(position).asc_nulls_last(), *more)


def mix_documents(docs: DataFrame, whole: bool = False, **settings) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row for each pass that takes words of it, in training order.

    A row that the target cuts keeps its first words, and ``n_chars``, where there is one,
    is counted again. With ``whole`` no text is cut: that row comes whole if this is at least
    as near to the target as leaving it out, and else not at all. See ``plan_mix`` for the rest.
    """
    rows = plan_mix(docs, **settings)
    if whole:
        size = F.col("__size")
        near = F.filter("__copies", lambda copy: 2 * copy["words"] >= size)
        rows = rows.withColumn("__copies", F.transform(near, lambda copy: copy.withField("words", size)))
    rows = rows.where(F.size("__copies") > 0).withColumn("__copy", F.explode("__copies"))
    words, cut = F.col("__copy.words"), F.col("__copy.words") < F.col("__size")
    spaced = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    first = F.array_join(F.slice(spaced, F.lit(1), words.cast("int")), "")
    rows = rows.withColumn("__cut", cut).withColumn("text", F.when(cut, first).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.col("__cut"), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    rows = rows.withColumn("__position", F.col("__copy.position"))
    return _in_order(rows, "__position", ["__md5"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_plan(docs: DataFrame, **settings) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and the first position.

    Documents that are taken are in training order; the others follow them in each slice.
    """
    rows = plan_mix(docs.select("doc_id", "text", "source"), **settings).select(
        "doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), F.col("__taken").alias("taken"),
        F.round(F.try_element_at("__copies", F.lit(1))["position"], 9).alias("position"))
    return _in_order(rows, "position", ["doc_id", "size"])
