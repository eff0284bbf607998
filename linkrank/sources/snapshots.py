"""Graphs and rank snapshots as Parquet folders."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from linkrank import folders
from linkrank.operators.graph import LinkGraph, store_graph


def iteration_name(iteration: int) -> str:
    return f"iter{iteration:02d}"


def iteration_path(base_path: str, iteration: int) -> str:
    """Folder of the ranks that iteration number ``iteration`` starts from."""
    return f"{base_path.rstrip('/')}/{iteration_name(iteration)}"


def phase1_path(base_path: str, iteration: int) -> str:
    """Folder of the mass received in iteration number ``iteration``."""
    return iteration_path(base_path, iteration) + "t"


def layout_path(base_path: str) -> str:
    """Folder of the graph as the iterations use it."""
    return f"{base_path.rstrip('/')}/layout"


def write_graph(graph: LinkGraph, path: str) -> LinkGraph:
    """Store ``graph`` below ``path``, replacing what is there; returns the stored graph.

    ``graph`` may read from ``path`` itself: the old files stay until the new ones are complete.
    """
    return store_graph(graph, path)


def read_graph(spark: SparkSession, path: str) -> LinkGraph:
    """A graph that ``write_graph`` stored."""
    nodes = spark.read.schema("title STRING, out_degree BIGINT").parquet(f"{path}/nodes")
    edges = spark.read.schema("src STRING, dst STRING").parquet(f"{path}/edges")
    return LinkGraph(nodes, edges, is_stored=True)


def write_snapshot(table: DataFrame, path: str, mark: str = "") -> DataFrame:
    """Store one step of a run as the folder ``path`` and mark it as complete; returns what is stored."""
    spark = table.sparkSession
    folders.replace(spark, path, table.write.parquet, mark)
    return spark.read.schema(table.schema).parquet(path)


def read_ranks(spark: SparkSession, base_path: str, iteration: int) -> DataFrame:
    """The snapshot of one iteration; one that was not written to the end is refused."""
    path = iteration_path(base_path, iteration)
    if folders.mark_of(spark, path) is None:
        state = "was not written to the end" if folders.exists(spark, path) else "is not there"
        raise FileNotFoundError(f"snapshot {path} {state}")
    return spark.read.parquet(path)


def last_iteration(spark: SparkSession, base_path: str) -> int | None:
    """The highest number of a complete snapshot, from which a run can go on; None without any."""
    numbers = [int(name[4:]) for name in folders.children(spark, base_path) if re.fullmatch(r"iter\d{2,}", name)]
    for number in sorted(numbers, reverse=True):
        if folders.mark_of(spark, iteration_path(base_path, number)) is not None:
            return number
    return None
