"""Graph tables, their files, and reports."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import linkrank as lr

EDGES = [tuple(pair) for pair in "AB AC BC CA DC DZ EE EA ED FA".split()]


@pytest.fixture(scope="module")
def graph(spark):
    raw = spark.createDataFrame(EDGES + EDGES[:3], "src string, dst string")
    return lr.store_graph(lr.build_graph(raw))


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_edges_are_distinct_and_nodes_are_sources(graph):
    assert rows(graph.edges) == sorted(EDGES)
    assert rows(graph.nodes) == [("A", 2), ("B", 1), ("C", 1), ("D", 2), ("E", 3), ("F", 1)]


def test_counters_keep_repeated_links(spark):
    raw = spark.createDataFrame(EDGES + EDGES[:3], "src string, dst string")
    assert rows(lr.graph_counters(raw)) == [(6, 13)]


def test_summary_missing_and_duplicates(spark, graph):
    assert rows(lr.graph_summary(graph)) == [(6, 10)]
    assert rows(lr.missing_structure(graph)) == [("Z",)]
    pages = spark.createDataFrame([("a",), ("b",), ("a",)], "title string")
    assert rows(lr.duplicate_titles(pages)) == [("a", 2)]
    with pytest.raises(ValueError, match="'a' occurs 2 times"):
        lr.require_unique_titles(pages)


def test_graph_files_are_replaced(spark, graph, tmp_path):
    path = str(tmp_path / "g")
    lr.write_graph(graph, path)
    lr.write_graph(lr.build_graph(spark.createDataFrame(EDGES[:2], "src string, dst string")), path)
    back = lr.read_graph(spark, path)
    assert rows(back.edges) == [("A", "B"), ("A", "C")]
    assert rows(back.nodes) == [("A", 2)]


def test_adjacency_view(graph):
    view = lr.adjacency(graph).withColumn("links", F.array_sort("links"))
    got = {row["title"]: row for row in view.collect()}
    assert got["E"]["links"] == ["A", "D", "E"]
    assert got["E"]["type"] == "INITIALIZED"
    assert got["E"]["rank"] == float("-inf")
    assert not any(row["continued"] for row in got.values())


@pytest.mark.parametrize("links_per_row", [1, 2, 1000])
def test_adjacency_text_round_trip(spark, tmp_path, links_per_row):
    raw = [("hub", f"t{i}") for i in range(40)] + EDGES
    graph = lr.store_graph(lr.build_graph(spark.createDataFrame(raw, "src string, dst string")))
    ranks = graph.nodes.select("title", (F.col("out_degree") / 3).alias("rank"))
    path = str(tmp_path / "adj")
    for _ in range(2):
        lr.write_adjacency_text(lr.adjacency(graph, ranks, "COMPLETED", links_per_row), path)
    back = lr.read_adjacency_text(spark, path, continued_pages=True)
    lr.require_unique_titles(back)
    assert back.where("title = 'hub'").count() <= -(-40 // links_per_row)
    again = lr.graph_from_adjacency(back)
    assert rows(again.edges) == sorted(raw)
    assert rows(again.nodes) == rows(graph.nodes)
    assert rows(back.select("title", "rank").distinct()) == rows(ranks)
    assert rows(back.select("type").distinct()) == [("COMPLETED",)]


def read(spark, tmp_path, *lines):
    path = tmp_path / "adj.txt"
    path.write_text("".join(line + "\n" for line in lines))
    return lr.read_adjacency_text(spark, str(path))


def test_adjacency_lines(spark, tmp_path):
    got = read(
        spark, tmp_path,
        "Tea_pot\tINITIALIZED\t-Infinity\tkettle\tclay\tkettle",
        "Lonely\tCOMPLETED\t0.25",
        "Trailing\tMASS\t1e-3\ta\t\t",
        "Float\tSTRUCTURE\t-1.5f\ta",
        "\tINITIALIZED\tNaN\tx",
    ).collect()
    assert [(row["title"], row["type"], row["links"]) for row in got] == [
        ("Tea_pot", "INITIALIZED", ["kettle", "clay"]),
        ("Lonely", "COMPLETED", []),
        ("Trailing", "MASS", ["a"]),
        ("Float", "STRUCTURE", ["a"]),
        ("", "INITIALIZED", ["x"]),
    ]
    assert [row["rank"] for row in got][:4] == [float("-inf"), 0.25, 0.001, -1.5]


@pytest.mark.parametrize("line", [
    "no tabs", "A\tINITIALIZED", "A\tINITIALIZED\t", "A\tINVALID\t1.0\tb", "A\tinitialized\t1.0",
    "A\tCOMPLETED\tone\tb", "A\tCOMPLETED\t1.0x", "",
])
def test_malformed_lines_fail_the_job(spark, tmp_path, line):
    with pytest.raises(Exception, match="malformed adjacency line"):
        read(spark, tmp_path, "A\tCOMPLETED\t1.0\tb", line).count()


@pytest.mark.parametrize("title, kind, link, message", [
    ("A\tB", "COMPLETED", "x", "tab or line break"),
    ("A", "COMPLETED", "x\ny", "tab or line break"),
    ("A", "INVALID", "x", "page type"),
    ("A", None, "x", "page type"),
])
def test_what_text_cannot_hold_is_refused(spark, tmp_path, title, kind, link, message):
    row = spark.createDataFrame([(title, kind, 1.0, [link], False)],
                                "title string, type string, rank double, links array<string>, continued boolean")
    with pytest.raises(Exception, match=message):
        lr.write_adjacency_text(row, str(tmp_path / "adj"))


def test_titles_without_links_stay(spark, tmp_path):
    adjacency = read(spark, tmp_path, "A\tINITIALIZED\t-Infinity\tB", "B\tINITIALIZED\t-Infinity")
    graph = lr.store_graph(lr.graph_from_adjacency(adjacency))
    assert rows(graph.nodes) == [("A", 1), ("B", 0)]
    out = str(tmp_path / "out")
    lr.write_adjacency_text(lr.adjacency(graph), out)
    assert sorted(line["value"] for line in spark.read.text(out).collect()) == [
        "A\tINITIALIZED\t-Infinity\tB", "B\tINITIALIZED\t-Infinity"]


def test_type_histogram(spark):
    pages = spark.createDataFrame([("INITIALIZED",), ("COMPLETED",), ("COMPLETED",)], "type string")
    assert rows(lr.type_histogram(pages)) == [("COMPLETED", 2), ("INITIALIZED", 1)]


def test_preview(spark):
    raw = [("a", f"l{i}") for i in range(7)] + [("b", "x"), ("b", "y"), ("c", "z")]
    graph = lr.build_graph(spark.createDataFrame(raw, "src string, dst string"))
    got = {row["title"]: row["preview"] for row in lr.preview_graph(graph).collect()}
    assert got == {"a": "<l0\tl1\tl2\tl3\tl4 ...>", "b": "<x\ty>", "c": "<z>"}
    assert [row["title"] for row in lr.preview_graph(graph, 2).orderBy("title").collect()] == ["a", "b"]
    lonely = spark.createDataFrame([("q", [])], "title string, links array<string>")
    assert lr.preview_graph(lr.graph_from_adjacency(lonely)).first()["preview"] == "<>"


def test_top_pages(spark, tmp_path):
    ranks = [("e", 0.5), ("b", 0.9), ("a", 0.5), ("d", 0.1), ("c", 0.5 + 1e-15)]
    df = spark.createDataFrame(ranks, "title string, rank double")

    def titles(top):
        return [row["title"] for row in top.collect()]

    assert titles(lr.topk_pages(df, 3)) == ["b", "c", "a"]
    assert titles(lr.topk_pages(df, 3, tie_digits=12)) == ["b", "a", "c"]
    assert titles(lr.topk_pages(df)) == ["b", "c", "a", "e", "d"]
    twice = df.unionAll(spark.createDataFrame([("b", 0.2), ("d", 0.7)], df.schema))
    assert titles(lr.topk_pages(twice, 2, unique=False)) == ["b", "d"]
    with pytest.raises(ValueError):
        lr.topk_pages(df, 0)
    path = str(tmp_path / "top")
    lr.write_topk_text(lr.topk_pages(df, 3), path)
    assert [line["value"] for line in spark.read.text(path).collect()] == [
        "b\t0.9", "c\t0.500000000000001", "a\t0.5"]
    assert rows(lr.read_topk_text(spark, path)) == rows(lr.topk_pages(df, 3))


def test_intermediate_tables_live_in_the_named_folder(spark):
    from linkrank.session import scratch_folder, shared_folder

    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder.rstrip("/")
    assert scratch_folder(spark, "x") != scratch_folder(spark, "x")
    graph = lr.build_graph(spark.createDataFrame(EDGES, "src string, dst string"))
    assert all(folder in file for file in lr.store_graph(graph).edges.inputFiles())


@pytest.fixture
def long_pages(spark, tmp_path):
    """A graph written with two links per line, and its ranks after one iteration."""
    edges = [("hub", x) for x in "abcde"] + [(x, "hub") for x in "abc"]
    graph = lr.build_graph(spark.createDataFrame(edges, "src string, dst string"))
    path = str(tmp_path / "long")
    lr.write_adjacency_text(lr.adjacency(graph, lr.pagerank_basic(graph, 1), "COMPLETED", 2), path)
    return graph, lr.read_adjacency_text(spark, path, continued_pages=True)


def test_rows_of_long_pages_do_not_change_results(long_pages):
    graph, text = long_pages
    assert text.where("continued").count() > 0
    assert rows(lr.type_histogram(text)) == [("COMPLETED", 4)]
    assert rows(lr.duplicate_titles(text)) == []
    ranks = lr.pagerank_basic(graph, 1)
    assert rows(lr.contributions(graph, text)) == rows(lr.contributions(graph, ranks))
    assert rows(lr.preview_graph(graph, ranks=text)) == rows(lr.preview_graph(graph, ranks=ranks))
    again = lr.pagerank_basic(lr.graph_from_adjacency(text), 2, start=2, ranks=text)
    assert rows(again.select("title", F.round("rank", 12))) == rows(
        lr.pagerank_basic(graph, 2).select("title", F.round("rank", 12)))


def test_missing_repeated_and_unfit_ranks_fail(spark, long_pages):
    graph, text = long_pages
    few = spark.createDataFrame([("hub", 1.0)], "title string, rank double")
    for report in (lr.adjacency(graph, few), lr.preview_graph(graph, ranks=few), lr.contributions(graph, few)):
        with pytest.raises(Exception, match="no rank given"):
            report.collect()
    with pytest.raises(Exception, match="more than once"):
        lr.graph_from_adjacency(text.union(text.where("title = 'a'"))).nodes.collect()
    for bad in (float("nan"), -1.0, float("inf")):
        unfit = text.where("NOT continued").select("title", F.lit(bad).alias("rank"))
        with pytest.raises(Exception, match="no rank stored"):
            lr.pagerank_basic(graph, 2, start=2, ranks=unfit)


def test_texts_keep_rare_titles(spark, tmp_path):
    titles = ["a\tb", "c\u0085", "d\u2028e", "\u2029"]
    top = spark.createDataFrame([(t, float(i)) for i, t in enumerate(titles)], "title string, rank double")
    lr.write_topk_text(top, str(tmp_path / "top"))
    assert rows(lr.read_topk_text(spark, str(tmp_path / "top"))) == rows(top)
    broken = spark.createDataFrame([("x\ny", 1.0)], "title string, rank double")
    with pytest.raises(Exception, match="line break"):
        lr.write_topk_text(broken, str(tmp_path / "broken"))
    links = spark.createDataFrame([("p", "B"), ("p", "\u0085")], "src string, dst string")
    lr.write_adjacency_text(lr.adjacency(lr.build_graph(links)), str(tmp_path / "links"))
    back = lr.graph_from_adjacency(lr.read_adjacency_text(spark, str(tmp_path / "links")))
    assert rows(back.edges.select("src", "dst")) == rows(links)


def test_an_empty_first_link_is_a_link_unless_asked(spark, tmp_path):
    (tmp_path / "t").write_text("p\tINITIALIZED\t0.5\t\tq\n")
    row = lr.read_adjacency_text(spark, str(tmp_path / "t")).first()
    assert (row.links, row.continued) == (["", "q"], False)
