"""One step of rank computation: tables, messages, and the two update rules."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkrank import constants as C
from linkrank import folders
from linkrank.operators.graph import (
    LinkGraph,
    broadcast_if_small,
    missing_structure,
    require_unique_titles,
    store_graph,
    title_rows,
)
from linkrank.operators.skew import HOT_ROWS, copy_to_splits, hot_keys, hot_limit, split_rows
from linkrank.session import drop_scratch, scratch_folder, stored


@dataclass(frozen=True)
class RankTables:
    """A graph laid out for iterating.

    ``vertices(id, title, out_degree, live_degree[, splits])`` is partitioned by ``id``
    and ``edges(src, dst[, split])`` by its ``keys``, unless the graph is small; both are
    kept for the whole run.
    ``edges`` holds the links between vertices only: what is sent to other targets is
    lost in every iteration, and ``live_degree`` says how much that is.

    ``buckets`` is the number of partitions of tables that were opened from a stored layout,
    ``mark`` says which one that was. ``scratch`` are the folders and ``names`` the tables
    that go when the run is over.
    """

    vertices: DataFrame
    edges: DataFrame
    keys: list[str]
    n_vertices: int
    buckets: int = 0
    mark: str = ""
    scratch: tuple[str, ...] = ()
    names: tuple[str, ...] = ()

    @property
    def state_columns(self) -> list[str]:
        """What an iteration needs to know of a vertex besides its rank."""
        return [c for c in self.vertices.columns if c != "title"]

    def release(self) -> None:
        """Give memory and disk back: the kept tables, the folders of this run, the names of stored ones."""
        spark = self.vertices.sparkSession
        self.vertices.unpersist()
        self.edges.unpersist()
        for name in self.names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        for folder in self.scratch:
            drop_scratch(spark, folder)


def rank_tables(graph: LinkGraph, hot_rows: int = HOT_ROWS, layout: str | None = None) -> RankTables:
    """Lay out ``graph``: short keys, live edges, one shuffle of the edges for all iterations.

    A graph with at most ``hot_rows`` links in all is left as it is read: one task could
    handle it, and fixed partitions would only cost time.

    With the path of a ``layout`` the tables are stored there as buckets, and a later run, in
    another session too, opens them as they are: its edges are not joined, shuffled or split
    again. A layout of another graph, or of another ``hot_rows``, is replaced.
    """
    scratch = []
    if not graph.is_stored:
        scratch.append(scratch_folder(graph.edges.sparkSession, "graph"))
        graph = store_graph(graph, scratch[0])
    if layout is None:
        scratch.append(scratch_folder(graph.edges.sparkSession, "tables"))
        made = _laid_out(graph, hot_rows, scratch[-1], scratch[-1])
        # Both tables are written before they are kept in memory: what an executor loses is
        # then read and shuffled again, not joined and counted again.
        keep = lambda df, keys: _kept(df, keys) if made.buckets else df.persist()
        return replace(made, vertices=keep(made.vertices, ["id"]), edges=keep(made.edges, made.keys), buckets=0,
                       scratch=tuple(scratch))
    wanted = _fingerprint(graph, hot_rows)
    tables = _opened(graph.edges.sparkSession, layout, wanted)
    if tables is None:
        _store_layout(graph, hot_rows, layout, wanted)
        tables = _opened(graph.edges.sparkSession, layout, wanted)
    return replace(tables, scratch=tuple(scratch))


def _laid_out(graph: LinkGraph, hot_rows: int, folder: str, work: str, as_buckets: bool = False) -> RankTables:
    """The tables as files below ``folder``, plain or in buckets; helper tables go below ``work``.

    ``buckets`` is how many each table is worth, 0 for a small graph, which is always plain.
    """
    nodes, edges = graph.nodes, graph.edges
    spark = nodes.sparkSession
    facts = nodes.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("out_degree"), F.lit(0)).alias("links"),
        F.coalesce(F.max("out_degree"), F.lit(0)).alias("most"),
        F.count_distinct(F.xxhash64("title")).alias("keys"),
    ).first()
    limit = hot_limit(facts["links"], hot_rows)
    is_large = facts["links"] > limit
    vertices = nodes.select(F.xxhash64("title").alias("id"), "title", "out_degree")
    ends = edges.select(F.xxhash64("src").alias("src"), F.xxhash64("dst").alias("dst"), F.col("dst").alias("title"))
    if facts["keys"] < facts["n"]:
        # A repeated title, or two titles with one hash.
        require_unique_titles(nodes)
        vertices, ends = _with_other_ids(vertices, edges, work)
    live = _live_edges(vertices, ends, limit if is_large else None, work)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions")) if is_large else 0
    keys = ["src"]
    if facts["most"] > limit:
        keys = ["src", "split"]
        hot_sources = hot_keys(vertices.selectExpr("id AS src", "out_degree"), "out_degree", limit)
        live = split_rows(live, "src", "dst", hot_sources)
        splits = F.greatest(F.ceil(F.col("out_degree") / F.lit(limit)), F.lit(1)).cast("int")
        vertices = vertices.withColumn("splits", splits)
    written = _stored_in_buckets if as_buckets and buckets else lambda df, path, *_: stored(df, path)
    live = written(live, f"{folder}/edges", keys, buckets)
    live_degrees = live.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("live_degree"))
    vertices = vertices.join(live_degrees, "id", "left").withColumn(
        "live_degree", F.coalesce("live_degree", F.lit(0))
    )
    vertices = written(vertices, f"{folder}/vertices", ["id"], buckets)
    return RankTables(vertices, live, keys, facts["n"], buckets)


def _with_other_ids(vertices: DataFrame, edges: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Vertices and edge ends in which titles that share a hash have ids of their own.

    Only these titles are looked up; they get the smallest numbers that are nobody's hash.
    There is about one such pair in five billion titles, so the table of them is small; it is
    broadcast if a count says so.
    """
    shared = vertices.groupBy("id").agg(F.count("*").alias("titles")).where("titles > 1").select("id")
    clashing = stored(vertices.join(shared, "id", "left_semi").select("title"), f"{folder}/clashing")
    count = clashing.count()
    numbers = vertices.sparkSession.range(2 * count).select(F.col("id").alias("other"))
    taken = vertices.where(F.col("id").between(0, 2 * count)).select(F.col("id").alias("other"))
    # At most ``count`` of the numbers below twice the count are some other title's hash.
    free = numbers.join(taken, "other", "left_anti").withColumn("at", F.row_number().over(Window.orderBy("other")))
    lined_up = clashing.withColumn("at", F.row_number().over(Window.orderBy("title")))
    others = broadcast_if_small(stored(lined_up.join(free, "at").select("title", "other"), f"{folder}/others"))

    def renumbered(rows: DataFrame, title: str, name: str) -> DataFrame:
        known = rows.join(others.withColumnRenamed("title", title), title, "left")
        return known.withColumn(name, F.coalesce("other", F.xxhash64(title))).drop("other")

    ends = renumbered(edges.select("src", F.col("dst").alias("title")), "title", "dst")
    ends = renumbered(ends.withColumnRenamed("src", "from"), "from", "src").select("src", "dst", "title")
    return renumbered(vertices.drop("id"), "title", "id").select("id", "title", "out_degree"), ends


def _fingerprint(graph: LinkGraph, hot_rows: int) -> str:
    """What tells one stored graph, and the way it is laid out, from others: counts and sums of hashes of all rows."""
    def told(table: DataFrame, *columns: str) -> list[int]:
        return list(table.agg(F.count("*"), F.bit_xor(F.xxhash64(*columns)), F.bit_xor(F.xxhash64(F.lit(1), *columns))).first())

    found = [*told(graph.nodes, "title", "out_degree"), *told(graph.edges, "src", "dst"), hot_rows]
    return " ".join(map(str, found))


def _store_layout(graph: LinkGraph, hot_rows: int, path: str, wanted: str) -> None:
    """Write the tables of ``graph`` below ``path``: as buckets if it is large, with their facts in the mark."""
    spark = graph.nodes.sparkSession
    work = scratch_folder(spark, "layout")
    facts = {}

    def write(folder: str) -> None:
        made = _laid_out(graph, hot_rows, folder, work, as_buckets=True)
        facts.update({
            "graph": wanted, "keys": made.keys, "n": made.n_vertices, "buckets": made.buckets,
            "vertices": _columns(made.vertices), "edges": _columns(made.edges),
        })

    folders.replace(spark, path, write, lambda: json.dumps(facts))
    drop_scratch(spark, work)


def _stored_in_buckets(table: DataFrame, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write ``table`` to ``path`` as that many buckets and read its files back.

    Rows are not sorted here: Spark would sort by bucket and key, row against row, while
    ``_opened`` sorts by the key alone, for what it keeps.
    """
    spark = table.sparkSession
    # A task has whole buckets, so each bucket is one file. The name is only needed to write.
    alias = _table_name()
    dealt = table.repartition(buckets, *keys).write.bucketBy(buckets, *keys)
    dealt.option("path", path).format("parquet").saveAsTable(alias)
    spark.sql(f"DROP TABLE {alias}")
    return spark.read.schema(table.schema).parquet(path)


def _opened(spark: SparkSession, path: str, wanted: str) -> RankTables | None:
    """The layout at ``path``, if there is a complete one of the ``wanted`` graph."""
    facts = json.loads(folders.mark_of(spark, path) or "{}")
    if facts.get("graph") != wanted:
        return None
    opened, names = {}, []
    for name, keys in (("vertices", ["id"]), ("edges", facts["keys"])):
        folder = f"{path.rstrip('/')}/{name}"
        if not facts["buckets"]:
            opened[name] = spark.read.schema(facts[name]).parquet(folder).persist()
            continue
        names.append(_table_name())
        place, by = folder.replace("\\", "\\\\").replace("'", "\\'"), ", ".join(keys)
        spark.sql(f"CREATE TABLE {names[-1]} ({facts[name]}) USING parquet CLUSTERED BY ({by}) "
                  f"INTO {facts['buckets']} BUCKETS LOCATION '{place}'")
        opened[name] = spark.table(names[-1]).sortWithinPartitions(*keys).persist(StorageLevel.MEMORY_AND_DISK)
    return RankTables(opened["vertices"], opened["edges"], facts["keys"], facts["n"], facts["buckets"], wanted,
                      names=tuple(names))


def _columns(table: DataFrame) -> str:
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in table.schema.fields)


def _table_name() -> str:
    return f"linkrank_{uuid.uuid4().hex}"


def _kept(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` partitioned and sorted by ``keys``, in memory or on the executors' disks."""
    return (
        df.repartition(*keys).sortWithinPartitions(*keys).persist(StorageLevel.MEMORY_AND_DISK)
    )


def _live_edges(vertices: DataFrame, edges: DataFrame, limit: int | None, folder: str) -> DataFrame:
    """``src, dst`` of the ``edges(src, dst, title)`` whose target is a vertex.

    The key of the target leads, being quick to sort by, and the title decides, so that
    equal hashes mix nothing up. Targets above ``limit`` are split.
    """
    targets = vertices.selectExpr("id AS dst", "title")
    if limit is None:
        return edges.join(targets, ["dst", "title"], "left_semi").select("src", "dst")
    popular = edges.groupBy("dst").agg(F.count("*").alias("in_degree"))
    hot = stored(hot_keys(popular, "in_degree", limit), f"{folder}/hot-targets")
    copies = targets.join(F.broadcast(hot), "dst", "left").withColumn(
        "splits", F.coalesce("splits", F.lit(1))
    )
    return (
        split_rows(edges, "dst", "src", hot)
        .join(copy_to_splits(copies), ["dst", "split", "title"], "left_semi")
        .select("src", "dst")
    )


def initial_state(tables: RankTables, rank: float) -> DataFrame:
    """Every vertex with the same rank."""
    return tables.vertices.select(*tables.state_columns, F.lit(float(rank)).alias("rank"))


def state_from_ranks(tables: RankTables, ranks: DataFrame) -> DataFrame:
    """The state that ``ranks(title, rank)`` describes; each vertex must have a rank.

    Ranks may also come as their logarithms, ``log_rank``, alone. A rank is finite and not
    negative; anything else fails the job.
    """
    rank = F.col("rank") if "rank" in ranks.columns else F.exp("log_rank")
    given = title_rows(ranks).select("title", rank.cast("double").alias("rank"))
    is_sound = (F.col("rank") >= 0) & (F.col("rank") < float("inf"))
    found = F.coalesce(F.col("rank").cast("string"), F.lit("no rank"))
    failure = F.raise_error(F.concat(F.lit("no rank stored for "), "title", F.lit(": "), found))
    rank = F.when(is_sound, F.col("rank")).otherwise(failure.cast("double"))
    return tables.vertices.join(given, "title", "left").select(*tables.state_columns, rank.alias("rank"))


def messages(tables: RankTables, state: DataFrame) -> DataFrame:
    """``dst, mass``: the share of its rank that each vertex sends along each live edge."""
    senders = state.where("live_degree > 0")
    if "split" in tables.keys:
        senders = copy_to_splits(senders)
    senders = senders.selectExpr("id AS src", *tables.keys[1:], "rank / out_degree AS mass")
    if tables.buckets:
        # As many parts as the stored edges have, whatever this session's number is.
        senders = senders.repartition(tables.buckets, *tables.keys)
    return tables.edges.join(senders, tables.keys).select("dst", "mass")


def mass_per_target(sent: DataFrame) -> DataFrame:
    """``dst, mass`` summed; each task adds up a popular target before the shuffle."""
    return sent.groupBy("dst").agg(F.sum("mass").alias("mass"))


def receive_mass(tables: RankTables, state: DataFrame) -> DataFrame:
    """Phase 1: all vertices with the ``mass`` sent to them, 0 where nothing was sent."""
    received = mass_per_target(messages(tables, state)).withColumnRenamed("dst", "id")
    return tables.vertices.join(received, "id", "left").selectExpr(
        *tables.vertices.columns, "coalesce(mass, 0D) AS mass"
    )


def mass_reaching() -> Column:
    """Aggregate over a state: the mass that its vertices send to vertices.

    The live share of each vertex gives the sum without sending anything.
    """
    reaching = F.expr("CASE WHEN live_degree > 0 THEN rank * live_degree / out_degree END")
    return F.coalesce(F.sum(reaching), F.lit(0.0))


def missing_mass(state: DataFrame) -> DataFrame:
    """One row, ``missing_mass``: the probability that does not reach any vertex.

    Rounding must not push it below 0.
    """
    return state.agg(F.greatest(F.lit(0.0), 1 - mass_reaching()).alias("missing_mass"))


def jump_or_follow(mass: Column, missing: float, n: int, alpha: float = C.ALPHA) -> Column:
    """Phase 2: jump anywhere with ``alpha``, else follow a link; missing mass goes to all alike."""
    return F.lit(alpha / n) + F.lit(1 - alpha) * (mass + F.lit(missing / n))


def damped(mass: Column, alpha: float = C.ALPHA) -> Column:
    """Update of the basic variant, where ``alpha`` weighs the link mass; ranks do not sum to 1."""
    return F.lit(1 - alpha) + F.lit(alpha) * mass


def contributions(graph: LinkGraph, ranks: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``src, dst, mass`` of one round over titles, targets outside the graph included."""
    rank = F.coalesce("rank", F.raise_error(F.concat(F.lit("no rank given for "), "title")).cast("double"))
    given = title_rows(ranks).select("title", "rank")
    senders = graph.nodes.join(given, "title", "left").withColumn("rank", rank).select(
        F.col("title").alias("src"),
        "out_degree",
        (F.col("rank") / F.nullif("out_degree", F.lit(0))).alias("mass"),
    )
    facts = graph.nodes.agg(
        F.coalesce(F.sum("out_degree"), F.lit(0)).alias("links"),
        F.coalesce(F.max("out_degree"), F.lit(0)).alias("most"),
    ).first()
    limit = hot_limit(facts["links"], hot_rows)
    if facts["most"] <= limit:
        sent = graph.edges.join(senders, "src")
    else:
        hot = hot_keys(graph.nodes.withColumnRenamed("title", "src"), "out_degree", limit)
        copies = senders.withColumn(
            "splits", F.greatest(F.ceil(F.col("out_degree") / F.lit(limit)), F.lit(1)).cast("int")
        )
        rows = split_rows(graph.edges, "src", "dst", hot)
        sent = rows.join(copy_to_splits(copies), ["src", "split"])
    return sent.select("src", "dst", "mass")


# Width of a band of log masses: sums of exp() within a band stay well inside a double,
# and the usual masses lie in the middle band, which needs no shift.
_BAND = 512


def log_mass_sum(sent: DataFrame) -> DataFrame:
    """``dst, log_mass``: ``ln(sum(exp(log_mass)))`` per target, for masses of any size.

    Masses are first added up within bands of similar size, so one row per target and
    band is left to combine, relative to the highest band of the target. A mass that is no
    number or +Infinity fails the job with its target's title.
    """
    unfit = F.isnan("log_mass") | (F.col("log_mass") == float("inf"))
    failure = F.raise_error(F.concat(F.lit("log mass is not finite for "), "dst")).cast("bigint")
    nearest = F.round(F.col("log_mass") / _BAND).cast("bigint")
    band = F.when(unfit, failure).when(F.col("log_mass") > float("-inf"), nearest)
    within = F.exp(F.col("log_mass") - F.col("band") * _BAND)
    per_band = sent.select("dst", "log_mass", band.alias("band")).groupBy("dst", "band").agg(
        F.sum(within).alias("mass")
    )
    top = F.max("band").over(Window.partitionBy("dst"))
    scaled = F.col("mass") * F.exp((F.col("band") - F.col("top")) * _BAND)
    per_target = per_band.withColumn("top", top).groupBy("dst").agg(
        F.max("top").alias("top"), F.coalesce(F.sum(scaled), F.lit(0.0)).alias("mass")
    )
    return per_target.select(
        "dst",
        F.when(F.col("mass") == 0, F.lit(float("-inf")))
        .otherwise(F.ln("mass") + F.col("top") * _BAND)
        .alias("log_mass"),
    )


def iteration_counters(graph: LinkGraph) -> DataFrame:
    """``metric, value``: what one iteration handles, the same for both variants.

    Every edge carries one message and every message arrives, even where no node waits.
    """
    links = F.coalesce(F.sum("out_degree"), F.lit(0))
    nodes = graph.nodes.agg(
        F.count("*").alias(C.NODES), links.alias(C.EDGES), links.alias(C.MASS_MESSAGES_SENT)
    )
    received = graph.edges.agg(F.count("*").alias(C.MASS_MESSAGES_RCVD))
    missing = missing_structure(graph).agg(F.count("*").alias(C.MISSING_STRUCTURE))
    tables = [df.unpivot([], df.columns, "metric", "value") for df in (nodes, received, missing)]
    return tables[0].unionAll(tables[1]).unionAll(tables[2])


def rank_mass_total(ranks: DataFrame) -> DataFrame:
    """One row, ``total``: the sum of the ranks, 1 for the log variant."""
    return ranks.agg(F.sum("rank").alias("total"))
