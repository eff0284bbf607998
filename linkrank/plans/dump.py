"""From a dump to its highest-ranked pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank import constants as C
from linkrank.operators.graph import LinkGraph, build_graph, store_graph
from linkrank.operators.pages import page_edges, parse_counters, parse_pages
from linkrank.operators.topk import topk_pages
from linkrank.plans.pagerank import pagerank_log
from linkrank.session import scratch_folder, stored
from linkrank.sources.dump import read_tagged_records
from linkrank.sources.reports import write_counters


def parse_dump(spark: SparkSession, dump_path: str | list[str], work_path: str, *,
               start_tag: str = C.PAGE_START, end_tag: str = C.PAGE_END) -> LinkGraph:
    """Read a dump once and store what follows from it below ``work_path``.

    ``pages`` holds the parsed pages, ``graph`` the link graph, which is returned, and
    ``counters`` the counts over both: pages by fate, vertices, links before they are
    made distinct.
    """
    records = read_tagged_records(spark, dump_path, start_tag, end_tag)
    parsed = stored(parse_pages(records), f"{work_path}/pages")
    graph = store_graph(build_graph(page_edges(parsed)), f"{work_path}/graph")
    raw = parsed.agg(F.coalesce(F.sum(F.size("links")), F.lit(0)).alias(C.EDGES))
    vertices = graph.nodes.agg(F.count("*").alias(C.VERTICES))
    counters = parse_counters(parsed)
    for table in (vertices, raw):
        counters = counters.unionAll(table.unpivot([], table.columns, "metric", "value"))
    write_counters(counters, f"{work_path}/counters")
    return graph


def dump_to_topk(spark: SparkSession, dump_path: str | list[str], iterations: int, k: int = C.TOP_K,
                 work_path: str | None = None, tie_digits: int | None = None) -> DataFrame:
    """``title, log_rank`` of the ``k`` highest-ranked pages of a dump."""
    work_path = work_path or scratch_folder(spark, "dump")
    graph = parse_dump(spark, dump_path, work_path)
    ranks = pagerank_log(graph, iterations, base_path=f"{work_path}/ranks")
    return topk_pages(ranks, k, "log_rank", tie_digits)
