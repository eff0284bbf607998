"""What the physical plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest

import linkrank as lr
from linkrank.operators.ranking import initial_state
from linkrank.session import stored


def plan(df, keep_cached=False):
    text = df._jdf.queryExecution().executedPlan().toString()
    if keep_cached:
        return text
    # Leave out how kept tables were made: only what runs per query counts.
    lines, depth = [], None
    for line in text.split("\n"):
        indent = len(line) - len(line.lstrip(" :+-*"))
        if depth is None or indent <= depth:
            depth = indent if "InMemoryRelation" in line else None
            lines.append(line)
    return "\n".join(lines)


def exchanges(text):
    return re.findall(r"Exchange (\w+\([^)]*\))", text)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def graph(spark):
    raw = [(f"p{i % 50}", f"p{(i * 7) % 60}") for i in range(600)] + [("p1", f"q{i}") for i in range(99)]
    return lr.store_graph(lr.build_graph(spark.createDataFrame(raw, "src string, dst string")))


@pytest.mark.parametrize("hot_rows, keys", [(150, ["src"]), (20, ["src", "split"])])
def test_an_iteration_moves_ranks_and_partial_sums_only(graph, tmp_path, no_broadcast, hot_rows, keys):
    tables = lr.rank_tables(graph, hot_rows)
    assert tables.keys == keys
    tables.vertices.count(), tables.edges.count()
    state = stored(initial_state(tables, 1.0), str(tmp_path / "state"))
    text = plan(lr.receive_mass(tables, state).drop("title"))
    moved = exchanges(text)
    assert len(moved) == 2, text
    # Partial sums are shuffled, and kept tables are neither shuffled nor sorted again.
    assert text.count("partial_sum") == 1
    assert text.count("Sort [") == 2
    assert "title" not in re.findall(r"InMemoryTableScan \[([^\]]*)\]", text)[0]
    tables.release()


def test_no_plan_holds_python_code_or_a_cross_join(spark, graph):
    ranks = lr.pagerank_log(graph, 1)
    records = spark.createDataFrame([("<page></page>",)], "rec string")
    parsed = lr.parse_pages(records)
    frames = [
        ranks, lr.topk_pages(ranks), lr.adjacency(graph, ranks), lr.preview_graph(graph, 0, ranks),
        lr.missing_structure(graph), lr.iteration_counters(graph), lr.page_edges(parsed),
        lr.parse_counters(parsed), lr.contributions(graph, ranks),
        lr.log_mass_sum(lr.contributions(graph, ranks).withColumnRenamed("mass", "log_mass")),
    ]
    for df in frames:
        text = plan(df, keep_cached=True)
        for word in ("Python", "Pandas", "CartesianProduct", "NestedLoop"):
            assert word not in text


def test_the_dump_is_read_in_one_pass_of_projections(spark, tmp_path):
    (tmp_path / "d.xml").write_text("<page><title>a</title></page>")
    parsed = lr.parse_pages(lr.read_tagged_records(spark, str(tmp_path / "d.xml")))
    text = plan(parsed)
    assert exchanges(text) == []
    # Each mark is searched for once per page (a test for its presence aside).
    for mark in ("<ns>", "<title>", "<text"):
        assert len(re.findall(rf"instr\(rec#\d+, {mark}\)", text)) == 1
    # Neither the links nor the fate are computed a second time in a filter.
    filters = [line for line in plan(lr.page_edges(parsed)).split("\n") if "Filter" in line]
    assert filters and not any("regexp" in line or "CASE" in line for line in filters)


def test_top_list_reads_two_columns_and_keeps_k_rows_per_task(spark, graph, tmp_path):
    lr.pagerank_log(graph, 1, base_path=str(tmp_path))
    text = plan(lr.topk_pages(lr.read_ranks(spark, str(tmp_path), 2), 5))
    assert "TakeOrderedAndProject(limit=5" in text
    assert "ReadSchema: struct<title:string,rank:double>" in re.sub(
        r"struct<rank:double,title:string>", "struct<title:string,rank:double>", text)


def test_preview_cuts_long_lists_before_the_shuffle(graph):
    text = plan(lr.preview_graph(graph))
    assert re.search(r"WindowGroupLimit .*6, Partial", text)


def test_adjacency_broadcasts_long_pages_only(graph, no_broadcast):
    text = plan(lr.adjacency(graph, links_per_row=50))
    assert text.count("BroadcastExchange") == 1
    assert "GreaterThan(out_degree,50)" in text


def test_summary_needs_no_edges(graph):
    text = plan(lr.graph_summary(graph))
    assert text.count("FileScan") == 1
    assert "ReadSchema: struct<out_degree:bigint>" in text


def test_targets_are_made_distinct_before_they_are_joined(graph, no_broadcast):
    text = plan(lr.missing_structure(graph))
    assert "LeftAnti" in text
    # Two steps of deduplication, the first before any row of the edges is moved.
    assert text.index("LeftAnti") < text.index("HashAggregate")
    assert text.count("HashAggregate(keys=[title") == 2
