"""One query per operator: ``(spark, sf_dir) -> DataFrame`` over the whole tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import linkrank as lr
from linkrank import constants as C
from linkrank.functions import log_add, normalize_title, safe_ln, unescape_entities
from linkrank.operators import pages as P
from linkrank.operators.ranking import initial_state, jump_or_follow
from linkrank.session import scratch_folder, stored
from workloads.fixtures import (
    succession_graph,
    succession_graphs,
    succession_raw,
    table,
    wiki_dump,
    wiki_records,
)

Query = Callable[[SparkSession, str], DataFrame]

ITERATIONS = 3
PREVIEW_PAGES = 25

# Links a page may have before it is split in the stored layout.
LAYOUT_HOT_ROWS = 4

# Decimals compared, and decimals on which equal ranks agree.
DIGITS = 8
TIE_DIGITS = 12


def rounded(column: str) -> F.Column:
    return F.round(column, DIGITS).alias(column)


def log_ranks(ranks: DataFrame) -> DataFrame:
    return ranks.select("title", rounded("log_rank"))


def plain_ranks(ranks: DataFrame) -> DataFrame:
    return ranks.select("title", rounded("rank"))


def as_text(adjacency: DataFrame) -> DataFrame:
    links = F.array_join(F.array_sort("links"), "\t").alias("links")
    return adjacency.select("title", "type", "rank", links)


# --- scan and parse ----------------------------------------------------------


def scan_xml_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lr.read_tagged_records(spark, wiki_dump(spark, sf_dir))


def scan_xml_bz2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lr.read_tagged_records(spark, wiki_dump(spark, sf_dir, "bzip2"))


def scan_custom_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lr.read_tagged_records(spark, wiki_dump(spark, sf_dir), "<revision>", "</revision>")


def filter_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = P.with_namespace(wiki_records(spark, sf_dir))
    return pages.where(P.is_article(F.col("rec"), F.col("namespace"))).select("p_partkey")


def extract_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.col("raw_title")
    return P.with_title(wiki_records(spark, sf_dir)).select(
        "p_partkey",
        title.isNotNull().alias("has_title"),
        F.coalesce(title, F.lit("")).alias("raw_title"),
    )


def extract_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("body")
    return P.with_body(wiki_records(spark, sf_dir)).select(
        "p_partkey", body.isNotNull().alias("has_body"), F.coalesce(body, F.lit("")).alias("body")
    )


def filter_redirect(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = P.with_body(wiki_records(spark, sf_dir))
    return pages.where(P.is_redirect(F.col("body"))).select("p_partkey")


def filter_disambiguation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = P.with_body(wiki_records(spark, sf_dir))
    return pages.where(P.is_disambiguation(F.col("body"))).select("p_partkey")


def filter_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = P.with_body(wiki_records(spark, sf_dir))
    return pages.where(P.is_stub(F.col("rec"), F.col("body"))).select("p_partkey")


def classify_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lr.classify_pages(wiki_records(spark, sf_dir))


def parse_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lr.parse_counters(lr.parse_pages(wiki_records(spark, sf_dir)))


def counters_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "counters")
    lr.write_counters(parse_counters(spark, sf_dir), path)
    return lr.read_counters(spark, path)


def dump_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve counters that a parse of dump files stores."""
    work = scratch_folder(spark, "dump-work")
    lr.parse_dump(spark, wiki_dump(spark, sf_dir), work)
    return lr.read_counters(spark, f"{work}/counters")


def extract_links_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lr.raw_links(lr.classify_pages(wiki_records(spark, sf_dir)))


def wiki_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lr.page_edges(lr.parse_pages(wiki_records(spark, sf_dir)))


def normalize_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.col("raw_title")
    return lr.classify_pages(wiki_records(spark, sf_dir)).select(
        title, normalize_title(title).alias("title")
    )


def unescape_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text")
    )
    documents = table(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text"
    )
    return pages.unionAll(documents).select("kind", "id", unescape_entities(F.col("text")).alias("text"))


def html_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lr.build_graph(lr.html_edges(table(spark, sf_dir, "pages"))).edges


# --- graph -------------------------------------------------------------------


def build_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = lr.store_graph(lr.build_graph(wiki_edges(spark, sf_dir)))
    return as_text(lr.adjacency(graph))


def graph_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    wiki = lr.graph_counters(wiki_edges(spark, sf_dir)).withColumn("graph", F.lit("wiki"))
    parts = lr.graph_counters(succession_raw(spark, sf_dir)).withColumn("graph", F.lit("parts"))
    return wiki.unionAll(parts)


def out_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    wiki = lr.build_graph(wiki_edges(spark, sf_dir)).nodes.withColumn("graph", F.lit("wiki"))
    parts = lr.build_graph(succession_raw(spark, sf_dir)).nodes.withColumn("graph", F.lit("parts"))
    return wiki.unionAll(parts)


def graph_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lr.graph_summary(succession_graph(spark, sf_dir))


def preview_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lr.preview_graph(succession_graph(spark, sf_dir), PREVIEW_PAGES)


def preview_graph_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = succession_graph(spark, sf_dir)
    ranks = lr.pagerank_basic(graph, 1)
    return lr.preview_graph(graph, 0, ranks).select("title", rounded("rank"), "preview")


def type_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = succession_graph(spark, sf_dir)
    before = lr.adjacency(graph).select("title", "type")
    after = lr.pagerank_log(graph, 1).select("title", "type")
    return lr.type_histogram(before.unionAll(after))


def missing_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lr.missing_structure(succession_graph(spark, sf_dir))


def html_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = normalize_title(F.regexp_extract("html", C.TITLE_PATTERN, 1))
    return table(spark, sf_dir, "pages").select("page_id", title.alias("title"))


def duplicate_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lr.duplicate_titles(html_titles(spark, sf_dir))


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "graph")
    lr.write_graph(lr.build_graph(succession_raw(spark, sf_dir)), path)
    graph = lr.read_graph(spark, path)
    return graph.edges.join(graph.nodes.withColumnRenamed("title", "src"), "src")


def graph_overwrites_itself(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A graph written to where it is read from."""
    path = scratch_folder(spark, "graph")
    lr.write_graph(lr.build_graph(succession_raw(spark, sf_dir)), path)
    lr.write_graph(lr.read_graph(spark, path), path)
    graph = lr.read_graph(spark, path)
    return graph.edges.join(graph.nodes.withColumnRenamed("title", "src"), "src")


def adjacency_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = succession_graph(spark, sf_dir)
    path = scratch_folder(spark, "adjacency")
    lr.write_adjacency_text(lr.adjacency(graph), path)
    return as_text(lr.read_adjacency_text(spark, path))


def adjacency_text_long_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = succession_graph(spark, sf_dir)
    path = scratch_folder(spark, "adjacency")
    lr.write_adjacency_text(lr.adjacency(graph, links_per_row=2), path)
    back = lr.read_adjacency_text(spark, path, continued_pages=True)
    lr.require_unique_titles(back)
    again = lr.store_graph(lr.graph_from_adjacency(back))
    return again.edges.join(again.nodes.withColumnRenamed("title", "src"), "src")


# --- ranks -------------------------------------------------------------------


def pagerank_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = succession_graph(spark, sf_dir)
    ranks = graph.nodes.select("title", F.lit(1.0).alias("rank"))
    return lr.mass_per_target(lr.contributions(graph, ranks)).select("dst", rounded("mass"))


def log_add_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = succession_graph(spark, sf_dir).nodes
    left = F.when(F.col("out_degree") % 5 == 0, F.lit(float("-inf"))).otherwise(-F.ln("out_degree"))
    right = F.when(F.col("out_degree") % 3 == 0, F.lit(float("-inf"))).otherwise(
        -F.ln(F.col("out_degree") + 1)
    )
    return nodes.select("title", F.round(log_add(left, right), DIGITS).alias("log_sum"))


def log_mass_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = succession_graph(spark, sf_dir)
    ranks = graph.nodes.select("title", F.lit(1.0).alias("rank"))
    sent = lr.contributions(graph, ranks).select("dst", safe_ln(F.col("mass")).alias("log_mass"))
    return lr.log_mass_sum(sent).select("dst", rounded("log_mass"))


def _phase1(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, float, int]:
    tables = lr.rank_tables(succession_graph(spark, sf_dir))
    state = stored(initial_state(tables, 1 / tables.n_vertices), scratch_folder(spark, "state"))
    mass = stored(lr.receive_mass(tables, state), scratch_folder(spark, "mass"))
    tables.release()
    return mass, lr.missing_mass(state).first()["missing_mass"], tables.n_vertices


def pagerank_phase1(spark: SparkSession, sf_dir: str) -> DataFrame:
    mass, _, _ = _phase1(spark, sf_dir)
    log_mass = safe_ln(F.col("mass"))
    return mass.select("title", rounded("mass"), F.round(log_mass, DIGITS).alias("log_mass"))


def pagerank_phase2(spark: SparkSession, sf_dir: str) -> DataFrame:
    mass, missing, n = _phase1(spark, sf_dir)
    rank = jump_or_follow(F.col("mass"), missing, n)
    return mass.select("title", F.round(safe_ln(rank), DIGITS).alias("log_rank"))


def _missing_masses(spark: SparkSession, name: str, graph: lr.LinkGraph) -> DataFrame:
    """``graph, iteration, missing_mass`` of each iteration of one graph."""
    base = scratch_folder(spark, "ranks")
    lr.pagerank_log(graph, ITERATIONS - 1, base_path=base)
    states = [lr.read_ranks(spark, base, i) for i in range(2, ITERATIONS + 1)]
    # The first iteration starts from the same vertices, with equal ranks.
    first = states[0].withColumn("rank", F.lit(1 / max(states[0].count(), 1)))
    rows = [
        lr.missing_mass(state).select(
            F.lit(name).alias("graph"), F.lit(iteration).alias("iteration"), rounded("missing_mass")
        )
        for iteration, state in enumerate([first, *states], 1)
    ]
    return reduce(DataFrame.unionAll, rows)


def missing_mass(spark: SparkSession, sf_dir: str) -> DataFrame:
    graphs = succession_graphs(spark, sf_dir)
    # Both graphs are ranked at once: the short stages of one leave executors to the other.
    with ThreadPoolExecutor(len(graphs)) as pool:
        runs = [pool.submit(inheritable_thread_target(_missing_masses), spark, *item) for item in graphs.items()]
    return reduce(DataFrame.unionAll, [run.result() for run in runs])


def pagerank_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_ranks(lr.pagerank_basic(succession_graph(spark, sf_dir), ITERATIONS))


def pagerank_basic_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacency text in, ranked adjacency text out."""
    path = scratch_folder(spark, "adjacency")
    lr.write_adjacency_text(lr.adjacency(succession_graph(spark, sf_dir)), path + "/iter01")
    lines = lr.read_adjacency_text(spark, path + "/iter01")
    graph = lr.store_graph(lr.graph_from_adjacency(lines))
    ranks = lr.pagerank_basic(graph, ITERATIONS)
    ranked = lr.adjacency(graph, ranks, C.COMPLETED)
    lr.write_adjacency_text(ranked, path + "/iter04")
    back = lr.read_adjacency_text(spark, path + "/iter04")
    return as_text(back).select("title", "type", rounded("rank"), "links")


def pagerank_basic_text_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last iteration from ranked adjacency text, in which pages take several lines."""
    graph = succession_graph(spark, sf_dir)
    path = scratch_folder(spark, "adjacency")
    ranks = lr.pagerank_basic(graph, ITERATIONS - 1)
    lr.write_adjacency_text(lr.adjacency(graph, ranks, C.COMPLETED, links_per_row=2), path)
    lines = lr.read_adjacency_text(spark, path, continued_pages=True)
    return plain_ranks(lr.pagerank_basic(lr.graph_from_adjacency(lines), ITERATIONS, ITERATIONS, ranks=lines))


def pagerank_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_ranks(lr.pagerank_log(succession_graph(spark, sf_dir), ITERATIONS))


def pagerank_log_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_ranks(lr.pagerank_log(succession_graph(spark, sf_dir, closed=True), ITERATIONS))


def pagerank_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = succession_graph(spark, sf_dir)
    base = scratch_folder(spark, "ranks")
    lr.pagerank_log(graph, ITERATIONS - 1, base_path=base)
    lr.pagerank_log(graph, ITERATIONS, ITERATIONS, base_path=base)
    ranks = lr.read_ranks(spark, base, ITERATIONS + 1)
    return log_ranks(ranks.withColumn("log_rank", safe_ln(F.col("rank"))))


def pagerank_resume_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last iterations on the stored layout, its edges in buckets, of the first ones."""
    graph = succession_graph(spark, sf_dir)
    base = scratch_folder(spark, "ranks")
    lr.pagerank_log(graph, 1, base_path=base, hot_rows=LAYOUT_HOT_ROWS)
    return log_ranks(lr.pagerank_log(graph, ITERATIONS, 2, base_path=base, hot_rows=LAYOUT_HOT_ROWS))


def pagerank_after_interruption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Goes on from the last complete snapshot, where the next one was not written to the end."""
    graph = succession_graph(spark, sf_dir)
    base = scratch_folder(spark, "ranks")
    lr.pagerank_log(graph, ITERATIONS - 1, base_path=base)
    half = lr.read_ranks(spark, base, ITERATIONS).where(F.xxhash64("title") % 2 == 0)
    half.write.parquet(lr.iteration_path(base, ITERATIONS + 1))
    return log_ranks(lr.pagerank_log(graph, ITERATIONS, lr.last_iteration(spark, base), base_path=base))


def pagerank_from_log_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = succession_graph(spark, sf_dir)
    ranks = lr.pagerank_log(graph, ITERATIONS - 1).select("title", "log_rank")
    return log_ranks(lr.pagerank_log(graph, ITERATIONS, ITERATIONS, ranks=ranks))


def pagerank_basic_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = succession_graph(spark, sf_dir)
    base = scratch_folder(spark, "ranks")
    lr.pagerank_basic(graph, ITERATIONS - 1, base_path=base)
    lr.pagerank_basic(graph, ITERATIONS, ITERATIONS, base_path=base)
    return plain_ranks(lr.read_ranks(spark, base, ITERATIONS + 1))


def pagerank_nodes_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = succession_graph(spark, sf_dir)
    return log_ranks(lr.pagerank_log(graph, ITERATIONS, nodes=2 * graph.nodes.count()))


def iteration_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lr.iteration_counters(succession_graph(spark, sf_dir))


def rank_mass_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = lr.pagerank_log(succession_graph(spark, sf_dir), ITERATIONS)
    return lr.rank_mass_total(ranks).select(F.round("total", 9).alias("total"))


def _top(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = lr.pagerank_log(succession_graph(spark, sf_dir), ITERATIONS)
    return lr.topk_pages(ranks, 10, "log_rank", TIE_DIGITS)


def topk_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir).select("title", rounded("log_rank"))


def topk_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "top")
    lr.write_topk_text(_top(spark, sf_dir), path)
    return lr.read_topk_text(spark, path, "log_rank").select("title", rounded("log_rank"))


def topk_repeated_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = html_titles(spark, sf_dir).select("title", F.col("page_id").cast("double").alias("rank"))
    return lr.topk_pages(ranks, 20, unique=False)


def topk_duplicates_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top list of titles that repeat, with how many do."""
    ranks = html_titles(spark, sf_dir).select("title", F.col("page_id").cast("double").alias("rank"))
    top, repeats = lr.topk_report(ranks, scratch_folder(spark, "top"), 20)
    return top.select("title", "rank", *(F.lit(value).cast("long").alias(name) for name, value in repeats.items()))


def dump_to_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = lr.dump_to_topk(spark, wiki_dump(spark, sf_dir), ITERATIONS, 10, tie_digits=TIE_DIGITS)
    return top.select("title", rounded("log_rank"))


QUERIES: dict[str, Query] = {
    "scan_xml_records": scan_xml_records,
    "scan_xml_bz2": scan_xml_bz2,
    "scan_custom_tags": scan_custom_tags,
    "filter_namespace": filter_namespace,
    "extract_title": extract_title,
    "extract_body": extract_body,
    "filter_redirect": filter_redirect,
    "filter_disambiguation": filter_disambiguation,
    "filter_stub": filter_stub,
    "classify_pages": classify_pages,
    "parse_counters": parse_counters,
    "counters_roundtrip": counters_roundtrip,
    "dump_counters": dump_counters,
    "extract_links_raw": extract_links_raw,
    "extract_links": wiki_edges,
    "normalize_titles": normalize_titles,
    "unescape_entities": unescape_texts,
    "html_link_graph": html_link_graph,
    "build_adjacency": build_adjacency,
    "graph_counters": graph_counters,
    "out_degree": out_degree,
    "graph_summary": graph_summary,
    "preview_graph": preview_graph,
    "preview_graph_all": preview_graph_all,
    "type_histogram": type_histogram,
    "missing_structure": missing_structure,
    "duplicate_titles": duplicate_titles,
    "snapshot_roundtrip": snapshot_roundtrip,
    "graph_overwrites_itself": graph_overwrites_itself,
    "adjacency_text_roundtrip": adjacency_text_roundtrip,
    "adjacency_text_long_pages": adjacency_text_long_pages,
    "pagerank_contributions": pagerank_contributions,
    "log_add": log_add_query,
    "log_mass_sum": log_mass_sum,
    "pagerank_phase1": pagerank_phase1,
    "pagerank_phase2": pagerank_phase2,
    "missing_mass": missing_mass,
    "pagerank_basic": pagerank_basic,
    "pagerank_basic_text": pagerank_basic_text,
    "pagerank_basic_text_resume": pagerank_basic_text_resume,
    "pagerank_basic_resume": pagerank_basic_resume,
    "pagerank_log": pagerank_log,
    "pagerank_log_closed": pagerank_log_closed,
    "pagerank_resume": pagerank_resume,
    "pagerank_resume_layout": pagerank_resume_layout,
    "pagerank_after_interruption": pagerank_after_interruption,
    "pagerank_from_log_ranks": pagerank_from_log_ranks,
    "pagerank_nodes_override": pagerank_nodes_override,
    "iteration_counters": iteration_counters,
    "rank_mass_total": rank_mass_total,
    "topk_pages": topk_pages,
    "topk_text_roundtrip": topk_text_roundtrip,
    "topk_repeated_titles": topk_repeated_titles,
    "topk_duplicates_report": topk_duplicates_report,
    "dump_to_topk": dump_to_topk,
}
