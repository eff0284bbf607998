"""Rank computation over a fixed number of iterations."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from linkrank import constants as C
from linkrank.folders import mark_of
from linkrank.functions.logmath import safe_ln
from linkrank.operators.graph import LinkGraph, require_unique_titles
from linkrank.operators.ranking import (
    RankTables,
    damped,
    initial_state,
    jump_or_follow,
    mass_reaching,
    missing_mass,
    rank_tables,
    receive_mass,
    state_from_ranks,
)
from linkrank.operators.skew import HOT_ROWS
from linkrank.session import drop_scratch, scratch_folder
from linkrank.sources.snapshots import iteration_path, layout_path, phase1_path, read_ranks, write_snapshot

log = logging.getLogger(__name__)

# The new rank of a vertex, from the mass it received and the mass missing in total.
NewRank = Callable[[Column, float], Column]


def pagerank_basic(graph: LinkGraph, end: int, start: int = 1, *, base_path: str | None = None,
                   ranks: DataFrame | None = None, alpha: float = C.ALPHA,
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """``title, type, rank`` after iterations ``start`` to ``end`` of the linear variant.

    Ranks start at 1 and do not sum to 1; mass sent to pages outside the graph is lost.
    With ``base_path`` the ranks after iteration i are kept in its folder ``iter{i+1}``
    and a later ``start`` continues from there, or from ``ranks`` if given. The folder
    ``layout`` there holds the graph as the iterations use it, for the next run. A snapshot
    is marked when it is complete; others are not read. ``last_iteration`` tells from which
    one an interrupted run can go on. Without ``base_path`` only the final ranks stay.
    """

    _check_range(start, end, base_path, ranks)
    tables = rank_tables(graph, hot_rows, base_path and layout_path(base_path))
    return _iterate(tables, start, end, 1.0, lambda mass, _: damped(mass, alpha), base_path, ranks, spread=False)


def pagerank_log(graph: LinkGraph, end: int, start: int = 1, *, nodes: int | None = None,
                 base_path: str | None = None, ranks: DataFrame | None = None,
                 alpha: float = C.ALPHA, keep_phase1: bool = False,
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """``title, type, rank, log_rank`` after iterations ``start`` to ``end``.

    Ranks start at 1/n and stay a probability distribution: what would be lost outside
    the graph is spread over all pages. ``nodes`` replaces the vertex count as n. Sums
    are taken in double precision, where no rank can underflow; ``log_rank`` is the
    natural logarithm. ``base_path`` and ``ranks`` work as in ``pagerank_basic``; ``ranks``
    may also hold ``log_rank`` alone. ``keep_phase1`` also keeps the mass received in iteration i in ``iter{i}t``.
    """

    _check_range(start, end, base_path, ranks)
    if nodes is not None and nodes < 1:
        raise ValueError(f"nodes must be at least 1, got {nodes}")
    tables = rank_tables(graph, hot_rows, base_path and layout_path(base_path))
    n = nodes or max(tables.n_vertices, 1)

    def new_rank(mass: Column, missing: float) -> Column:
        return jump_or_follow(mass, missing, n, alpha)

    final = _iterate(tables, start, end, 1 / n, new_rank, base_path, ranks, keep_phase1)
    return final.withColumn("log_rank", safe_ln(F.col("rank")))


def _check_range(start: int, end: int, base_path: str | None, ranks: DataFrame | None) -> None:
    if not 1 <= start <= end:
        raise ValueError(f"need 1 <= start <= end, got start {start} and end {end}")
    if start > 1 and base_path is None and ranks is None:
        raise ValueError("a later start needs base_path or ranks to continue from")


def _first_state(tables: RankTables, start: int, initial_rank: float, folder: str, ranks: DataFrame | None) -> DataFrame:
    """What the first iteration of this run starts from."""
    if start == 1:
        return initial_state(tables, initial_rank)
    if ranks is not None:
        require_unique_titles(ranks)
        return state_from_ranks(tables, ranks)
    spark = tables.vertices.sparkSession
    ranks = read_ranks(spark, folder, start)
    if tables.mark and mark_of(spark, iteration_path(folder, start)) == tables.mark:
        # A run over this very layout wrote it, with all that a state needs.
        return ranks.select(*tables.state_columns, "rank")
    return state_from_ranks(tables, ranks)


def _iterate(tables: RankTables, start: int, end: int, initial_rank: float, new_rank: NewRank,
             base_path: str | None, ranks: DataFrame | None,
             keep_phase1: bool = False, spread: bool = True) -> DataFrame:
    spark = tables.vertices.sparkSession
    folder = base_path or scratch_folder(spark, "ranks")
    try:
        state = _first_state(tables, start, initial_rank, folder, ranks)
        missing = missing_mass(state).first()["missing_mass"] if spread else 0.0
        for iteration in range(start, end + 1):
            log.info("iteration %d, missing mass %.12f", iteration, missing)
            received = receive_mass(tables, state)
            if keep_phase1:
                received = write_snapshot(received, phase1_path(folder, iteration), tables.mark)
            columns = list(tables.state_columns)
            if base_path is not None or iteration == end:
                columns += ["title", F.lit(C.COMPLETED).alias("type")]
            after = received.select(*columns, new_rank(F.col("mass"), missing).alias("rank"))
            # The sum for the next iteration is taken while the ranks are written. It stands
            # on top of the plan, in the tasks that write, and Spark counts the result of
            # such a task once however often it is tried.
            sums = Observation()
            if spread:
                after = after.observe(sums, mass_reaching().alias("reaching"))
            # The written table is what the next iteration reads: plans stay short and a
            # lost executor costs no more than its part of one iteration.
            state = write_snapshot(after, iteration_path(folder, iteration + 1), tables.mark)
            missing = max(0.0, 1 - sums.get["reaching"]) if spread else 0.0
            if base_path is None and iteration > start:
                # Its successor is complete, and so is what was made of that.
                drop_scratch(spark, iteration_path(folder, iteration))
    finally:
        tables.release()
    return state.select("title", "type", "rank")
