"""The link graph as two tables, and reports on it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkrank import constants as C
from linkrank import folders
from linkrank.functions.logmath import NEGATIVE_INFINITY
from linkrank.operators.skew import copy_to_splits, hot_limit, split_rows
from linkrank.session import scratch_folder, stored

# Longest list of links that is built into one row.
LINKS_PER_ROW = 1_000_000

# Rows that may be broadcast; counted before each use.
BROADCAST_ROWS = 500_000

# Links shown per page in a preview.
PREVIEW_LINKS = 5


@dataclass(frozen=True)
class LinkGraph:
    """``nodes(title, out_degree)`` and distinct ``edges(src, dst)``.

    Edges stay rows: a page with any number of links spreads over many tasks.
    Targets need not be nodes. ``is_stored`` says that both tables come from files,
    so reading them again is cheap; ``only_sources`` that there are no other nodes
    than the sources of the edges.
    """

    nodes: DataFrame
    edges: DataFrame
    is_stored: bool = False
    only_sources: bool = True


def source_nodes(edges: DataFrame) -> DataFrame:
    """``title, out_degree`` of the sources of distinct edges, dangling targets included."""
    return edges.groupBy(F.col("src").alias("title")).agg(F.count("*").alias("out_degree"))


def build_graph(raw_edges: DataFrame) -> LinkGraph:
    """Distinct edges; the nodes are the titles that have at least one link."""
    edges = raw_edges.select("src", "dst").distinct()
    return LinkGraph(source_nodes(edges), edges)


def title_rows(pages: DataFrame) -> DataFrame:
    """One row per page: without the rows that only continue the links of a long one."""
    return pages.where("NOT continued") if "continued" in pages.columns else pages


def _with_rank(pages: DataFrame, ranks: DataFrame) -> DataFrame:
    """``pages`` with the ``rank`` of their title; a page without one fails the job."""
    given = title_rows(ranks).select("title", "rank")
    rank = F.coalesce("rank", F.raise_error(F.concat(F.lit("no rank given for "), "title")).cast("double"))
    return pages.join(given, "title", "left").withColumn("rank", rank)


def graph_from_adjacency(adjacency: DataFrame) -> LinkGraph:
    """The graph of adjacency rows. A title without links stays a node, of degree 0.

    A title that has two rows of its own, not counting continued ones, fails the job.
    """
    head = ~F.col("continued") if "continued" in adjacency.columns else F.lit(True)
    rows = adjacency.select("title", head.alias("head"), F.posexplode_outer("links").alias("at", "dst"))
    is_head = F.col("head") & (F.coalesce("at", F.lit(0)) == 0)
    links = rows.groupBy("title", "dst").agg(F.count_if(is_head).alias("heads"))
    nodes = links.groupBy("title").agg(F.count("dst").alias("out_degree"), F.sum("heads").alias("heads"))
    repeated = F.raise_error(F.concat(F.lit("title occurs more than once: "), "title")).cast("bigint")
    nodes = nodes.select("title", F.when(F.col("heads") > 1, repeated).otherwise(F.col("out_degree")).alias("out_degree"))
    links = links.drop("heads")
    edges = links.where(F.col("dst").isNotNull()).withColumnRenamed("title", "src")
    return LinkGraph(nodes, edges, only_sources=False)


def store_graph(graph: LinkGraph, path: str | None = None) -> LinkGraph:
    """Write both tables below ``path``, or below the shared folder.

    Nodes that are just sources are counted from the edges already written, so the
    job that made the edges runs once. What is at ``path`` is replaced when both are complete.
    """
    spark = graph.edges.sparkSession
    path = (path or scratch_folder(spark, "graph")).rstrip("/")

    def write(folder: str) -> None:
        edges = stored(graph.edges, f"{folder}/edges")
        recount = graph.only_sources and not graph.is_stored
        stored(source_nodes(edges) if recount else graph.nodes, f"{folder}/nodes")

    folders.replace(spark, path, write)
    nodes = spark.read.schema(graph.nodes.schema).parquet(f"{path}/nodes")
    edges = spark.read.schema(graph.edges.schema).parquet(f"{path}/edges")
    return LinkGraph(nodes, edges, True, graph.only_sources)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast what a count shows to be small; leave the rest to a shuffled join."""
    return F.broadcast(df) if df.count() <= max_rows else df


def _split_edges(graph: LinkGraph, links_per_row: int) -> DataFrame:
    """``src, dst, split``: which of its page's rows each link goes to, at most ``links_per_row`` to one on average.

    The pages with most links, fewer than 10,000, are broadcast. The number of rows of any
    other long page meets its links in a join, where no page has more than a ten-thousandth
    of all links, and the links of the former are spread already.
    """
    number = lambda splits: F.pmod(F.xxhash64("dst"), splits).cast("int")
    pages = graph.nodes.select(F.col("title").alias("src"), "out_degree").where(F.col("out_degree") > links_per_row)
    links = pages.agg(F.coalesce(F.sum("out_degree"), F.lit(0))).first()[0]
    limit = hot_limit(links, links_per_row)
    splits = F.ceil(F.col("out_degree") / links_per_row).cast("int").alias("splits")
    hot = pages.where(F.col("out_degree") > limit).select("src", splits)
    spread = split_rows(graph.edges, "src", "dst", hot)
    if limit == links_per_row:
        return spread
    # Their links are all in one split so far; from a column, so that the join is by split too.
    once = F.least(F.col("out_degree"), F.lit(1)).cast("int").alias("parts")
    others = pages.where(F.col("out_degree") <= limit).select("src", splits, once)
    others = broadcast_if_small(copy_to_splits(others, "parts"))
    met = spread.join(others, ["src", "split"], "left")
    return met.select("src", "dst", F.coalesce(number(F.col("splits")), F.col("split")).alias("split"))


def adjacency(graph: LinkGraph, ranks: DataFrame | None = None, page_type: str = C.INITIALIZED,
              links_per_row: int = LINKS_PER_ROW) -> DataFrame:
    """``title, type, rank, links, continued``: the graph with a list of links per page.

    Without ``ranks`` (``title, rank``) every rank is -Infinity. A page with more than
    ``links_per_row`` links takes several rows, all but one marked ``continued``, so
    that no list outgrows a task.
    """
    splits = F.greatest(F.ceil(F.col("out_degree") / links_per_row), F.lit(1)).cast("int")
    nodes = graph.nodes.select(F.col("title").alias("src"), splits.alias("splits"))
    if ranks is None:
        nodes = nodes.withColumn("rank", F.lit(NEGATIVE_INFINITY))
    else:
        nodes = _with_rank(nodes.withColumnRenamed("src", "title"), ranks).withColumnRenamed("title", "src")
    lists = (
        _split_edges(graph, links_per_row)
        .groupBy("src", "split")
        .agg(F.collect_list("dst").alias("links"))
    )
    rows = copy_to_splits(nodes).join(lists, ["src", "split"], "left")
    return rows.where((F.col("split") == 0) | F.col("links").isNotNull()).select(
        F.col("src").alias("title"),
        F.lit(page_type).alias("type"),
        "rank",
        F.coalesce("links", F.array().cast("array<string>")).alias("links"),
        (F.col("split") > 0).alias("continued"),
    )


def graph_counters(raw_edges: DataFrame) -> DataFrame:
    """``vertices`` and ``edges_raw``: distinct sources, and links before deduplication."""
    return raw_edges.agg(
        F.count_distinct("src").alias("vertices"), F.count("*").alias("edges_raw")
    )


def graph_summary(graph: LinkGraph) -> DataFrame:
    """``nodes`` and ``edges`` of a graph, from its node table alone."""
    return graph.nodes.agg(
        F.count("*").alias("nodes"),
        F.coalesce(F.sum("out_degree"), F.lit(0)).alias("edges"),
    )


def type_histogram(pages: DataFrame) -> DataFrame:
    """``type, pages``: stored pages per state; a page in several rows counts once."""
    return title_rows(pages).groupBy("type").agg(F.count("*").alias("pages"))


def duplicate_titles(pages: DataFrame, title: str = "title") -> DataFrame:
    """``title, pages`` of the titles that occur more than once."""
    counts = title_rows(pages).groupBy(F.col(title).alias("title")).agg(F.count("*").alias("pages"))
    return counts.where("pages > 1")


def require_unique_titles(pages: DataFrame) -> None:
    """Fail if a title occurs twice; rows that continue a long page do not count."""
    example = duplicate_titles(pages).first()
    if example is not None:
        raise ValueError(f"title {example['title']!r} occurs {example['pages']} times")


def missing_structure(graph: LinkGraph) -> DataFrame:
    """``title`` of every link target that is no node."""
    targets = graph.edges.select(F.col("dst").alias("title")).distinct()
    return targets.join(graph.nodes.select("title"), "title", "left_anti")


def preview_graph(graph: LinkGraph, n: int = 0, ranks: DataFrame | None = None) -> DataFrame:
    """``title, rank, preview`` of the first ``n`` titles, all for 0.

    The preview shows the first few links in order and whether there are more. Only
    that many links per page leave the tasks that read them.
    """
    pages = graph.nodes.select("title")
    if n > 0:
        pages = pages.orderBy("title").limit(n)
    edges = graph.edges.withColumnRenamed("src", "title")
    if n > 0:
        chosen = F.broadcast(pages) if n <= BROADCAST_ROWS else pages
        edges = edges.join(chosen, "title", "left_semi")
    first = Window.partitionBy("title").orderBy("dst")
    shown = (
        edges.withColumn("position", F.row_number().over(first))
        .where(F.col("position") <= PREVIEW_LINKS + 1)
        .groupBy("title")
        .agg(F.array_sort(F.collect_list("dst")).alias("links"))
    )
    links = F.coalesce("links", F.array().cast("array<string>"))
    preview = F.concat(
        F.lit("<"),
        F.array_join(F.slice(links, 1, PREVIEW_LINKS), "\t"),
        F.when(F.size(links) > PREVIEW_LINKS, " ...").otherwise(""),
        F.lit(">"),
    )
    if ranks is None:
        pages = pages.withColumn("rank", F.lit(NEGATIVE_INFINITY))
    else:
        pages = _with_rank(pages, ranks)
    return pages.join(shown, "title", "left").select("title", "rank", preview.alias("preview"))
