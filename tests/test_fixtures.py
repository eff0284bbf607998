"""The graphs that the queries are run on."""

from __future__ import annotations

import __spark_entry__ as contract
from linkrank.operators import ranking
from workloads import fixtures

# Order, line, part, flag: repeated lines, links that only some returned line makes, no flag, no part, no order.
LINES = [
    (1, 1, 10, "R"), (1, 2, 20, "N"), (1, 3, 10, "A"), (1, 3, 30, "R"), (1, 4, 20, "R"),
    (2, 1, 10, "N"), (2, 2, 20, "R"), (2, 3, 10, None), (2, 4, 40, None), (3, 1, None, "R"),
    (3, 2, 50, "R"), (3, 3, 50, "A"), (4, 2, 60, "R"), (None, 1, 10, "R"), (None, 2, 70, "R"), (5, None, 10, "R"),
]
SCHEMA = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_returnflag string"


def lines_folder(spark, tmp_path, lines):
    spark.createDataFrame(lines, SCHEMA).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_both_graphs_of_one_join_equal_the_single_ones(spark, tmp_path):
    sf_dir = lines_folder(spark, tmp_path, LINES)
    both = fixtures.succession_graphs(spark, sf_dir)
    assert list(both) == ["open", "closed"]
    for name, graph in both.items():
        single = fixtures.succession_graph(spark, sf_dir, name == "closed")
        assert rows(graph.edges) == rows(single.edges) != []
        assert rows(graph.nodes) == rows(single.nodes) != []
        assert graph.edges.dtypes == single.edges.dtypes and graph.nodes.dtypes == single.nodes.dtypes
    assert rows(both["open"].edges) != rows(both["closed"].edges)


def test_no_returned_line_makes_an_empty_open_graph(spark, tmp_path):
    sf_dir = lines_folder(spark, tmp_path, [(1, 1, 10, "N"), (1, 2, 20, None), (1, 3, 10, "A")])
    both = fixtures.succession_graphs(spark, sf_dir)
    assert rows(both["open"].edges) == rows(both["open"].nodes) == []
    assert rows(both["closed"].edges) == [("10", "20"), ("20", "10")]


def test_missing_mass_joins_lines_once_and_lays_each_graph_out_once(spark, tmp_path, monkeypatch):
    sf_dir = lines_folder(spark, tmp_path, [line for line in LINES if None not in line])
    joined, made = [], []
    table, lay_out = fixtures.table, ranking._laid_out
    monkeypatch.setattr(fixtures, "table", lambda *a: joined.append(a[2]) or table(*a))
    monkeypatch.setattr(ranking, "_laid_out", lambda *a, **k: made.append(1) or lay_out(*a, **k))
    assert contract.queries()["missing_mass"](spark, sf_dir).count() == 6
    assert joined == ["lineitem"]
    assert len(made) == 2
