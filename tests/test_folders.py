"""Folders that are replaced, marked and removed: snapshots, stored layouts, scratch tables."""

from __future__ import annotations

import os
import random
import re

import pytest
from pyspark.sql import functions as F

import linkrank as lr
from linkrank import folders
from linkrank.operators import graph as graph_module
from linkrank.operators.ranking import initial_state, messages
from linkrank.session import drop_scratch, scratch_folder, stored
from test_plans import exchanges, plan

EDGES = [("A", "B"), ("A", "C"), ("B", "C"), ("C", "A"), ("D", "C"), ("D", "Z"), ("E", "E"), ("E", "A"), ("E", "D"), ("F", "A")]


@pytest.fixture(scope="module")
def graph(spark):
    random.seed(7)
    pairs = {(f"p{int(random.random() ** 3 * 80)}", f"p{random.randrange(100)}") for _ in range(900)}
    return lr.store_graph(lr.build_graph(spark.createDataFrame(sorted(pairs), "src string, dst string")))


def values(ranks, column="rank"):
    return {row["title"]: row[column] for row in ranks.collect()}


def rows(df):
    return sorted(tuple(row) for row in df.collect())


# --- replacing -----------------------------------------------------------------


def test_a_failed_write_leaves_what_was_there(spark, tmp_path):
    path = str(tmp_path / "t")
    folders.replace(spark, path, spark.range(3).write.parquet, "first")

    def broken(folder):
        spark.range(9).write.parquet(folder)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        folders.replace(spark, path, broken, "second")
    assert spark.read.parquet(path).count() == 3 and folders.mark_of(spark, path) == "first"
    folders.replace(spark, path, spark.range(5).write.parquet, "größer")
    assert spark.read.parquet(path).count() == 5 and folders.mark_of(spark, path) == "größer"
    assert os.listdir(tmp_path) == ["t"]
    assert folders.mark_of(spark, str(tmp_path / "none")) is None


def test_a_folder_can_be_written_from_itself(spark, tmp_path):
    path = str(tmp_path / "g")
    lr.write_graph(lr.build_graph(spark.createDataFrame(EDGES, "src string, dst string")), path)
    before = rows(lr.read_graph(spark, path).edges), rows(lr.read_graph(spark, path).nodes)
    for _ in range(2):
        lr.write_graph(lr.read_graph(spark, path), path)
    graph = lr.read_graph(spark, path)
    assert (rows(graph.edges), rows(graph.nodes)) == before
    fewer = lr.LinkGraph(graph.nodes.where("title <> 'A'"), graph.edges.where("src <> 'A'"), True)
    lr.write_graph(fewer, path + "/")
    assert len(rows(lr.read_graph(spark, path).edges)) == 8
    text = str(tmp_path / "text")
    lr.write_adjacency_text(lr.adjacency(lr.read_graph(spark, path)), text)
    lines = rows(spark.read.text(text))
    lr.write_adjacency_text(lr.read_adjacency_text(spark, text), text)
    assert rows(spark.read.text(text)) == lines and len(lines) == 5


# --- snapshots -----------------------------------------------------------------


def test_a_half_written_snapshot_is_refused_and_the_run_goes_on(spark, graph, tmp_path, monkeypatch):
    base = str(tmp_path)
    straight = values(lr.pagerank_log(graph, 4))
    write = folders.replace
    monkeypatch.setattr(folders, "replace", lambda session, path, *rest: (_ for _ in ()).throw(OSError("disk")) if "iter04" in path
                        else write(session, path, *rest))
    with pytest.raises(OSError, match="disk"):
        lr.pagerank_log(graph, 4, base_path=base)
    monkeypatch.undo()
    assert lr.last_iteration(spark, base) == 3
    # Files, but no mark.
    lr.read_ranks(spark, base, 3).limit(5).write.parquet(lr.iteration_path(base, 4))
    with pytest.raises(FileNotFoundError, match="iter04 was not written to the end"):
        lr.read_ranks(spark, base, 4)
    with pytest.raises(FileNotFoundError, match="iter04 was not written to the end"):
        lr.pagerank_log(graph, 4, 4, base_path=base)
    with pytest.raises(FileNotFoundError, match="iter09 is not there"):
        lr.pagerank_log(graph, 9, 9, base_path=base)
    last = lr.last_iteration(spark, base)
    assert last == 3
    assert values(lr.pagerank_log(graph, 4, last, base_path=base)) == pytest.approx(straight)
    assert lr.last_iteration(spark, base) == 5 and lr.last_iteration(spark, base + "/none") is None


def test_ranks_may_come_as_logarithms(graph):
    ranks = lr.pagerank_log(graph, 2)
    logs = ranks.select("title", "log_rank")
    assert values(lr.pagerank_log(graph, 3, 3, ranks=logs)) == pytest.approx(values(lr.pagerank_log(graph, 3)))
    with pytest.raises(Exception, match="no rank stored"):
        lr.pagerank_log(graph, 3, 3, ranks=logs.withColumn("log_rank", F.lit(float("nan"))))


# --- stored layout -------------------------------------------------------------


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("hot_rows, keys", [(400, ["src"]), (20, ["src", "split"]), (1_000_000, ["src"])])
def test_a_later_run_opens_the_layout_as_it_is(spark, graph, tmp_path, no_broadcast, hot_rows, keys):
    layout, straight = str(tmp_path / "lay'out"), lr.rank_tables(graph, hot_rows)
    want = sorted(straight.edges.select("src", "dst").collect()), rows(straight.vertices.select("id", "title", "live_degree"))
    straight.release()
    first = lr.rank_tables(graph, hot_rows, layout)
    first.release()
    written = sorted(os.listdir(f"{layout}/edges"))
    # Another session with another number of partitions.
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "13")
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    again = lr.LinkGraph(session.read.parquet(*graph.nodes.inputFiles()), session.read.parquet(*graph.edges.inputFiles()), True)
    tables = lr.rank_tables(again, hot_rows, layout)
    assert sorted(os.listdir(f"{layout}/edges")) == written and tables.keys == keys
    got = sorted(tables.edges.select("src", "dst").collect()), rows(tables.vertices.select("id", "title", "live_degree"))
    assert got == want
    assert exchanges(plan(tables.edges, keep_cached=True)) == []
    state = stored(initial_state(tables, 1.0), str(tmp_path / "state"))
    if tables.buckets:
        # Only ranks are shuffled; where the kept edges come from, nothing is.
        moved = exchanges(plan(messages(tables, state), keep_cached=True))
        assert len(moved) == 1 and re.match(r"hashpartitioning\(src", moved[0])
    tables.release()
    assert not [t.name for t in session.catalog.listTables() if t.name.startswith("linkrank_")]
    assert folders.exists(spark, f"{layout}/edges")


def test_another_graph_replaces_the_layout(spark, graph, tmp_path):
    base = str(tmp_path)
    lr.pagerank_log(graph, 1, base_path=base, hot_rows=100)
    mark = folders.mark_of(spark, f"{base}/layout")
    other = lr.LinkGraph(graph.nodes, graph.edges.where("src <> 'p3'"), only_sources=True)
    straight = values(lr.pagerank_log(other, 3, hot_rows=100))
    assert values(lr.pagerank_log(other, 3, base_path=base, hot_rows=100)) == pytest.approx(straight)
    assert folders.mark_of(spark, f"{base}/layout") != mark


@pytest.mark.parametrize("hot_rows", [1_000_000, 100, 10])
def test_resumed_runs_on_a_layout_equal_straight_ones(spark, graph, tmp_path, hot_rows):
    for run, name in ((lr.pagerank_log, "log"), (lr.pagerank_basic, "basic")):
        base = str(tmp_path / name)
        run(graph, 2, base_path=base, hot_rows=hot_rows)
        assert values(run(graph, 4, 3, base_path=base, hot_rows=hot_rows)) == pytest.approx(values(run(graph, 4)))
        # A snapshot of another layout is matched by title.
        assert values(run(graph, 4, 3, base_path=base, hot_rows=hot_rows + 1)) == pytest.approx(values(run(graph, 4)))


# --- scratch -------------------------------------------------------------------


def test_a_run_leaves_one_folder_of_ranks(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    graph = lr.build_graph(spark.createDataFrame(EDGES, "src string, dst string"))
    before = set(os.listdir(folder))
    ranks = lr.pagerank_log(graph, 10, hot_rows=3)
    new = set(os.listdir(folder)) - before
    assert [name.split("-")[0] for name in new] == ["ranks"]
    assert os.listdir(f"{folder}/{new.pop()}") == ["iter11"]
    assert values(ranks) == pytest.approx(values(lr.pagerank_log(graph, 10)))


def test_only_folders_of_a_run_are_removed(spark, tmp_path):
    folder = scratch_folder(spark, "some")
    stored(spark.range(2), f"{folder}/inner")
    drop_scratch(spark, f"{folder}/inner")
    assert not folders.exists(spark, f"{folder}/inner") and folders.exists(spark, folder)
    shared = spark.conf.get("spark.checkpoint.dir")
    for path in (str(tmp_path), shared, f"{shared}/mine", f"{folder}/../mine", "/"):
        with pytest.raises(ValueError, match="no folder of a run"):
            drop_scratch(spark, path)


# --- lists, repeats, masses ----------------------------------------------------


def test_lists_are_split_without_a_long_broadcast(spark, no_broadcast, monkeypatch):
    """Even if no list may be broadcast, links of a page with very many are spread before they move."""
    raw = [("hub", f"q{i}") for i in range(300)] + [(f"m{i % 40}", f"q{i}") for i in range(400)] + [("s", "q1")]
    graph = lr.store_graph(lr.build_graph(spark.createDataFrame(raw, "src string, dst string")))
    want = rows(lr.adjacency(graph, links_per_row=5).select("title", F.array_sort("links"), "continued"))
    monkeypatch.setattr(graph_module, "broadcast_if_small", lambda df: df)
    monkeypatch.setattr(graph_module, "hot_limit", lambda links, hot_rows: 50)
    lists = lr.adjacency(graph, links_per_row=5)
    text = plan(lists)
    joins = re.findall(r"SortMergeJoin \[([^\]]*)\]", text)
    assert joins and all("split#" in keys for keys in joins), joins
    assert text.count("BroadcastExchange") == 1
    assert rows(lists.select("title", F.array_sort("links"), "continued")) == want
    longest = lists.groupBy("title").agg(F.max(F.size("links")).alias("n")).agg(F.max("n")).first()[0]
    assert longest < 25


def test_repeats_are_counted_with_the_top_list(spark, tmp_path, caplog):
    ranks = spark.createDataFrame([("a", 0.5), ("b", 0.25), ("a", 0.75), ("c", 0.1), ("a", 0.2), ("c", 0.05)], "title string, rank double")
    path = str(tmp_path / "top")
    top, repeats = lr.topk_report(ranks, path, 2)
    assert [tuple(row) for row in top.collect()] == [("a", 0.75), ("b", 0.25)]
    assert repeats == {"repeated_titles": 2, "repeated_rows": 3}
    assert "2 titles occur more than once" in caplog.text
    with pytest.raises(ValueError, match="2 titles occur more than once, in 3 rows too many"):
        lr.topk_report(ranks, path, 1, refuse=True)
    assert spark.read.parquet(path).count() == 2
    once, none = lr.topk_report(ranks.dropDuplicates(["title"]), path, 5, refuse=True)
    assert once.count() == 3 and none == {"repeated_titles": 0, "repeated_rows": 0}
    assert lr.topk_report(ranks.limit(0), path)[1] == none
    with pytest.raises(ValueError, match="unique=False"):
        lr.topk_pages(ranks, 1, repeats=object())


@pytest.mark.parametrize("bad", [float("nan"), float("inf")])
def test_masses_that_are_no_numbers_name_their_target(spark, bad):
    sent = spark.createDataFrame([("fine", -1.0), ("odd page", bad)], "dst string, log_mass double")
    with pytest.raises(Exception, match="log mass is not finite for odd page"):
        lr.log_mass_sum(sent).collect()
