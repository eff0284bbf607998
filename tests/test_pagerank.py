"""Rank computation on a six-vertex graph whose values are known, and its invariants."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

import linkrank as lr
from linkrank.operators import ranking
from linkrank.operators.ranking import initial_state, messages
from linkrank.sources.snapshots import iteration_name, layout_path

EDGES = [tuple(pair) for pair in "AB AC BC CA DC DZ EE EA ED FA".split()]

# Linear value of the rank, log variant, per iteration.
LOG_RANKS = {
    1: {"A": 0.3673611111, "B": 0.1076388889, "C": 0.3201388889, "D": 0.0840277778,
        "E": 0.0840277778, "F": 0.0368055556},
    2: {"A": 0.3581626157, "B": 0.1870804398, "C": 0.3142853009, "D": 0.054759838,
        "E": 0.054759838, "F": 0.0309519676},
    3: {"A": 0.3378457875, "B": 0.1810979335, "C": 0.3633892385, "D": 0.0443941093,
        "E": 0.0443941093, "F": 0.0288788219},
}
BASIC_RANKS = {
    1: {"A": 1.2, "B": 0.925, "C": 1.15, "D": 0.9, "E": 0.9, "F": 0.85},
    2: {"A": 1.195, "B": 0.94, "C": 1.14625, "D": 0.895, "E": 0.895, "F": 0.85},
    3: {"A": 1.1941875, "B": 0.939625, "C": 1.14775, "D": 0.89475, "E": 0.89475, "F": 0.85},
}
MISSING = {1: 0.0833333333, 2: 0.0420138889, 3: 0.027379919}


@pytest.fixture(scope="module")
def graph(spark):
    return lr.build_graph(spark.createDataFrame(EDGES * 2, "src string, dst string"))


def values(df, column="rank"):
    return {row["title"]: row[column] for row in df.collect()}


@pytest.mark.parametrize("iterations", [1, 2, 3])
def test_log_variant_reaches_known_values(graph, iterations):
    ranks = lr.pagerank_log(graph, iterations)
    assert values(ranks) == pytest.approx(LOG_RANKS[iterations], abs=1e-10)
    logs = {title: math.log(rank) for title, rank in LOG_RANKS[iterations].items()}
    assert values(ranks, "log_rank") == pytest.approx(logs, abs=1e-8)
    assert {row["type"] for row in ranks.collect()} == {"COMPLETED"}
    assert lr.rank_mass_total(ranks).first()["total"] == pytest.approx(1)


@pytest.mark.parametrize("iterations", [1, 2, 3])
def test_basic_variant_reaches_known_values(graph, iterations):
    assert values(lr.pagerank_basic(graph, iterations)) == pytest.approx(BASIC_RANKS[iterations])


@pytest.mark.parametrize("hot_rows", [1, 2])
def test_splitting_hot_pages_changes_no_rank(graph, hot_rows):
    tables = lr.rank_tables(graph, hot_rows)
    assert tables.keys == ["src", "split"]
    assert tables.edges.count() == 9
    tables.release()
    ranks = lr.pagerank_log(graph, 3, hot_rows=hot_rows)
    assert values(ranks) == pytest.approx(LOG_RANKS[3], abs=1e-10)
    ranks = lr.pagerank_basic(graph, 3, hot_rows=hot_rows)
    assert values(ranks) == pytest.approx(BASIC_RANKS[3])


def test_phase_one_and_missing_mass(spark, graph):
    tables = lr.rank_tables(graph)
    state = initial_state(tables, 1 / 6)
    mass = values(lr.receive_mass(tables, state), "mass")
    expected = {"A": 0.3888888889, "B": 0.0833333333, "C": 0.3333333333, "D": 0.0555555556,
                "E": 0.0555555556, "F": 0.0}
    assert mass == pytest.approx(expected, abs=1e-10)
    assert lr.missing_mass(state).first()[0] == pytest.approx(MISSING[1], abs=1e-10)
    tables.release()


def test_missing_mass_per_iteration_and_phase_one_snapshots(spark, graph, tmp_path):
    base = str(tmp_path)
    lr.pagerank_log(graph, 3, base_path=base, keep_phase1=True)
    for iteration in (2, 3):
        missing = lr.missing_mass(lr.read_ranks(spark, base, iteration)).first()[0]
        assert missing == pytest.approx(MISSING[iteration], abs=1e-10)
    mass = spark.read.parquet(f"{base}/iter03t").agg(F.sum("mass")).first()[0]
    assert 1 - mass == pytest.approx(MISSING[3], abs=1e-10)


def test_closed_graph_misses_nothing(spark):
    ring = spark.createDataFrame([(str(i), str((i * 7 + j) % 50)) for i in range(50) for j in range(4)],
                                 "src string, dst string")
    ranks = lr.pagerank_log(lr.build_graph(ring), 6)
    assert lr.rank_mass_total(ranks).first()[0] == pytest.approx(1)
    assert all(math.isfinite(row["log_rank"]) for row in ranks.collect())


def test_resumed_run_equals_straight_run(spark, graph, tmp_path):
    base = str(tmp_path)
    for run, key in ((lr.pagerank_log, "log"), (lr.pagerank_basic, "basic")):
        straight = values(run(graph, 3))
        run(graph, 2, base_path=f"{base}/{key}")
        assert values(run(graph, 3, 3, base_path=f"{base}/{key}")) == pytest.approx(straight)
        given = lr.read_ranks(spark, f"{base}/{key}", 2)
        assert values(run(graph, 3, 2, ranks=given)) == pytest.approx(straight)
        assert values(lr.read_ranks(spark, f"{base}/{key}", 4)) == pytest.approx(straight)
    # Running again replaces the snapshots.
    lr.pagerank_log(graph, 1, base_path=f"{base}/log")
    assert values(lr.read_ranks(spark, f"{base}/log", 2)) == pytest.approx(LOG_RANKS[1], abs=1e-10)


def test_resuming_needs_a_rank_for_every_vertex(spark, graph):
    partial = spark.createDataFrame([("A", 0.5)], "title string, rank double")
    with pytest.raises(Exception, match="no rank stored"):
        lr.pagerank_log(graph, 2, 2, ranks=partial)
    twice = spark.createDataFrame([("A", 0.5), ("A", 0.1)], "title string, rank double")
    with pytest.raises(ValueError, match="occurs 2 times"):
        lr.pagerank_log(graph, 2, 2, ranks=twice)


def test_node_count_can_be_given(graph):
    # Ranks start at 1/12, so half of the probability is missing and is spread again.
    got = values(lr.pagerank_log(graph, 1, nodes=12))
    n, missing = 12, 1 - (1 - MISSING[1]) / 2
    mass = {"A": 7 / 36, "F": 0.0}
    for title, received in mass.items():
        assert got[title] == pytest.approx(0.15 / n + 0.85 * (received + missing / n), abs=1e-9)


@pytest.mark.parametrize("start, end", [(0, 1), (3, 2), (-1, 4)])
def test_iteration_range_is_checked(graph, start, end):
    with pytest.raises(ValueError, match="start"):
        lr.pagerank_basic(graph, end, start)


def test_other_arguments_are_checked(graph):
    with pytest.raises(ValueError, match="continue"):
        lr.pagerank_log(graph, 3, 2)
    with pytest.raises(ValueError, match="nodes"):
        lr.pagerank_log(graph, 3, nodes=0)


def test_nodes_without_links_send_nothing_and_keep_their_place(spark):
    rows = [("A", ["B"]), ("B", []), ("C", ["A", "B"])]
    graph = lr.graph_from_adjacency(spark.createDataFrame(rows, "title string, links array<string>"))
    assert values(graph.nodes, "out_degree") == {"A": 1, "B": 0, "C": 2}
    ranks = values(lr.pagerank_log(graph, 1))
    missing = 1 / 3
    assert ranks["B"] == pytest.approx(0.05 + 0.85 * (1 / 3 + 1 / 6 + missing / 3))
    assert sum(ranks.values()) == pytest.approx(1)
    assert values(lr.pagerank_basic(graph, 1)) == pytest.approx({"A": 0.925, "B": 1.075, "C": 0.85})


def test_counters_of_an_iteration(graph):
    counters = {row["metric"]: row["value"] for row in lr.iteration_counters(graph).collect()}
    assert counters == {"NODES": 6, "EDGES": 10, "MASS_MESSAGES_SENT": 10,
                        "MASS_MESSAGES_RCVD": 10, "MISSING_STRUCTURE": 1}


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_contributions_reach_dangling_targets(spark, graph, hot_rows):
    ranks = graph.nodes.select("title", F.lit(1.0).alias("rank"))
    sent = lr.contributions(graph, ranks, hot_rows)
    assert sent.count() == 10
    mass = {row["dst"]: row["mass"] for row in lr.mass_per_target(sent).collect()}
    assert mass == pytest.approx({"A": 7 / 3, "B": 0.5, "C": 2.0, "D": 1 / 3, "E": 1 / 3, "Z": 0.5})


def test_log_masses_of_any_size_add_up(spark):
    rows = [("near", -1.0), ("near", -2.0), ("far", -5000.0), ("far", -5000.0), ("far", -9000.0),
            ("none", float("-inf")), ("some", float("-inf")), ("some", 3.0),
            ("edge", 511.9), ("edge", 512.1), ("big", 900.0), ("big", 900.0)]
    got = lr.log_mass_sum(spark.createDataFrame(rows, "dst string, log_mass double"))
    got = {row["dst"]: row["log_mass"] for row in got.collect()}
    assert got == pytest.approx({
        "near": math.log(math.exp(-1) + math.exp(-2)), "far": -5000 + math.log(2),
        "none": float("-inf"), "some": 3.0, "edge": 511.9 + math.log1p(math.exp(0.2)),
        "big": 900 + math.log(2)})


@pytest.mark.parametrize("hot_rows", [1_000_000, 3])
def test_equal_hashes_get_other_ids(spark, graph, monkeypatch, hot_rows):
    # Every title gets one and the same hash, and it is one of the numbers that are given instead.
    monkeypatch.setattr(F, "xxhash64", lambda *columns: F.lit(7).cast("long"))
    tables = lr.rank_tables(graph, hot_rows)
    assert dict(tables.vertices.dtypes)["id"] == "bigint"
    ids = [row["id"] for row in tables.vertices.collect()]
    assert len(set(ids)) == len(ids) and 7 not in ids
    tables.release()
    assert values(lr.pagerank_log(graph, 3)) == pytest.approx(LOG_RANKS[3], abs=1e-10)


def test_repeated_titles_are_refused(spark, graph):
    nodes = graph.nodes.unionAll(graph.nodes)
    with pytest.raises(ValueError, match="occurs 2 times"):
        lr.pagerank_log(lr.LinkGraph(nodes, graph.edges, only_sources=False), 1)


def test_random_graph_agrees_with_plain_arithmetic(spark):
    import random

    random.seed(3)
    pairs = {(f"p{int(random.random() ** 3 * 60)}", f"p{random.randrange(80)}") for _ in range(600)}
    pairs |= {("hub", f"p{i}") for i in range(80)} | {(f"p{i}", "hub") for i in range(60)}
    links: dict[str, list[str]] = {}
    for src, dst in pairs:
        links.setdefault(src, []).append(dst)
    n = len(links)
    rank = dict.fromkeys(links, 1 / n)
    for _ in range(4):
        mass = dict.fromkeys(links, 0.0)
        for src, targets in links.items():
            for dst in targets:
                if dst in mass:
                    mass[dst] += rank[src] / len(targets)
        missing = 1 - sum(mass.values())
        rank = {t: 0.15 / n + 0.85 * (m + missing / n) for t, m in mass.items()}
    graph = lr.build_graph(spark.createDataFrame(sorted(pairs), "src string, dst string"))
    for hot_rows in (10, 1_000_000):
        assert values(lr.pagerank_log(graph, 4, hot_rows=hot_rows)) == pytest.approx(rank)


def test_iteration_names():
    assert [iteration_name(i) for i in (1, 12, 123)] == ["iter01", "iter12", "iter123"]


def test_messages_are_sent_along_live_edges_only(graph):
    tables = lr.rank_tables(graph)
    assert messages(tables, initial_state(tables, 1.0)).count() == 9
    tables.release()


def test_layout_is_made_once_and_opened_as_it_was_stored(spark, graph, tmp_path, monkeypatch):
    made = []
    lay_out = ranking._laid_out
    monkeypatch.setattr(ranking, "_laid_out", lambda *a, **k: made.append(lay_out(*a, **k)) or made[-1])
    base = str(tmp_path)
    lr.pagerank_log(graph, 2, base_path=base, hot_rows=2)
    tables = lr.rank_tables(graph, 2, layout_path(base))
    assert len(made) == 1
    # What the layout was made from are its own buckets, not plain files that were written first.
    assert all("/_layout-new-" in file for file in made[0].edges.inputFiles())
    assert tables.buckets and tables.edges.count() == 9
    degrees = {row["title"]: (row["out_degree"], row["live_degree"]) for row in tables.vertices.collect()}
    assert degrees == {"A": (2, 2), "B": (1, 1), "C": (1, 1), "D": (2, 1), "E": (3, 3), "F": (1, 1)}
    state = initial_state(tables, 1 / 6)
    assert lr.missing_mass(state).first()[0] == pytest.approx(MISSING[1], abs=1e-10)
    tables.release()
