"""Scanning, classifying and counting pages."""

from __future__ import annotations

import bz2
import gzip

import pytest
from pyspark.sql import functions as F

import linkrank as lr


def page(title="<title>T</title>", ns="<ns>0</ns>", text="<text>[[A]]</text>"):
    return f"<page>{title}{ns}<revision>{text}</revision></page>"


OUTCOMES = [
    (page(), "ARTICLE"),
    (page(ns=""), "ARTICLE"),
    (page(ns="<ns>\n\t 0\r </ns>"), "ARTICLE"),
    (page(ns="<ns>1</ns>"), "NOT_ARTICLE"),
    (page(ns="<ns>00</ns>"), "NOT_ARTICLE"),
    (page(ns="<ns></ns>"), "NOT_ARTICLE"),
    (page(ns="<ns>1</ns><ns>0</ns>"), "NOT_ARTICLE"),
    (page(ns="<ns>0</ns><ns>1</ns>"), "ARTICLE"),
    (page(ns="<ns>0"), "NOT_ARTICLE"),
    (page(ns="<ns>\u00a00</ns>"), "NOT_ARTICLE"),
    (page(title=""), "NO_TITLE"),
    (page(title="<title>T"), "NO_TITLE"),
    (page(title="</title><title>T"), "NO_TITLE"),
    (page(title="<title></title>"), "EMPTY_TITLE"),
    (page(title="<title> </title>"), "ARTICLE"),
    (page(text=""), "NO_TEXT"),
    (page(text="<text/>"), "NO_TEXT"),
    (page(text="<text"), "NO_TEXT"),
    (page(text='<text bytes="0" />'), "NO_TEXT"),
    (page(text="<text></text>"), "EMPTY_TEXT"),
    (page(text='<text xml:space="preserve"></text>'), "EMPTY_TEXT"),
    (page(text="<text>x #redirect\n [[X]]</text>"), "REDIRECT"),
    (page(text="<text>#REDIRECT[[]]</text>"), "REDIRECT"),
    (page(text="<text>#REDIRECT [[a\nb]]</text>"), "ARTICLE"),
    (page(text="<text>#REDIRECT [X]</text>"), "ARTICLE"),
    (page(text="<text>{{Disambiguation}}</text>"), "DISAMBIGUATION"),
    (page(text="<text>{{disambig}}</text>"), "DISAMBIGUATION"),
    (page(text="<text>{{disambig|x}}</text>"), "ARTICLE"),
    (page(text="<text>#redirect [[a]] {{disambig}}</text>"), "REDIRECT"),
    (page(text="<text>{{geo-stub}}</text>"), "STUB"),
    (page(text="<text>{{geo-Stub}}</text>"), "ARTICLE"),
    (page(text="<text>a</text><x>Wikipedia:Stub</x>"), "STUB"),
    (page(text="<text>{{disambig}} {{geo-stub}}</text>"), "DISAMBIGUATION"),
    (page(text="<textarea>q</text>"), "ARTICLE"),
]


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame([(rec,) for rec, _ in OUTCOMES], "rec string")


def test_each_page_has_the_first_fate_that_applies(records):
    got = [row["outcome"] for row in lr.classify_pages(records).collect()]
    assert list(zip(OUTCOMES, got, strict=True)) == [((rec, want), want) for rec, want in OUTCOMES]


def test_counters(spark, records):
    got = {row["metric"]: row["value"] for row in lr.parse_counters(lr.parse_pages(records)).collect()}
    want = {"TOTAL_PAGES": len(OUTCOMES)}
    for _, outcome in OUTCOMES:
        if outcome != "ARTICLE":
            want[outcome] = want.get(outcome, 0) + 1
    want["NO_LINKS"] = 4
    assert got == want


def test_counters_survive_their_file(spark, records, tmp_path):
    counters = lr.parse_counters(lr.parse_pages(records))
    lr.write_counters(counters, str(tmp_path / "c"))
    lr.write_counters(counters, str(tmp_path / "c"))
    back = lr.read_counters(spark, str(tmp_path / "c"))
    assert sorted(back.collect()) == sorted(counters.collect())


def test_links_of_articles_only(spark):
    rows = [page(text="<text>[[A]] [[B b|x]] [[A]]</text>"), page(ns="<ns>4</ns>"),
            page(title="<title>U &amp; V</title>", text="<text>[[C]] [[x:y]]</text>"),
            page(title="<title>W</title>", text="<text>none</text>")]
    records = spark.createDataFrame([(r,) for r in rows], "rec string")
    edges = lr.page_edges(lr.parse_pages(records))
    assert sorted(tuple(row) for row in edges.collect()) == [
        ("T", "A"), ("T", "A"), ("T", "B_b"), ("U_&_V", "C")]
    graph = lr.build_graph(edges)
    assert sorted(tuple(row) for row in graph.nodes.collect()) == [("T", 2), ("U_&_V", 1)]
    raw = lr.raw_links(lr.classify_pages(records))
    assert sorted(row["link"] for row in raw.collect()) == ["A", "A", "B b|x", "C", "x:y"]


SCAN_CASES = {
    "<mediawiki><siteinfo/>\n<page>a</page>\n <page>b</page>": ["<page>a</page>", "<page>b</page>"],
    "<page>a</page> tail </page> x": ["<page>a</page>"],
    "<page>a</page><page>trunc": ["<page>a</page>"],
    "nothing here": [],
    "": [],
    "<<page>a\r\nb\n</page>": ["<page>a\r\nb\n</page>"],
    "<page></page>": ["<page></page>"],
    "<page>ü😀</page>": ["<page>ü😀</page>"],
    "junk</page><page>a</page>": ["<page>a</page>"],
    "</page>\n</page><page>a</page> x</page><page>b</page>": ["<page>a</page>", "<page>b</page>"],
    "only an end</page>": [],
    "><page>a</page>": ["<page>a</page>"],
}


@pytest.mark.parametrize("opener, suffix", [(open, ""), (bz2.open, ".bz2"), (gzip.open, ".gz")])
@pytest.mark.parametrize("number", range(len(SCAN_CASES)))
def test_scan_cases(spark, tmp_path, number, opener, suffix):
    text, want = list(SCAN_CASES.items())[number]
    path = tmp_path / f"dump.xml{suffix}"
    with opener(path, "wb") as file:
        file.write(text.encode())
    got = lr.read_tagged_records(spark, str(path)).collect()
    assert sorted(row["rec"] for row in got) == sorted(want)


@pytest.mark.parametrize("suffix", ["", ".bz2"])
def test_scan_reads_each_record_once_over_many_splits(spark, tmp_path, suffix):
    records = [f"<page><title>{i}</title>{'x' * (i * 37 % 3000)}</page>" for i in range(3000)]
    text = "<mediawiki>" + "\n".join(records) + "</mediawiki>"
    path = tmp_path / f"dump.xml{suffix}"
    (bz2.open if suffix else open)(path, "wb").write(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        scan = lr.read_tagged_records(spark, str(path))
        assert suffix or scan.rdd.getNumPartitions() > 20
        got = [row["rec"] for row in scan.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got) == sorted(records)


@pytest.mark.parametrize("opener, suffix", [(open, ""), (bz2.open, ".bz2")])
def test_heads_of_many_files_are_no_records(spark, tmp_path, opener, suffix):
    """Parts of a dump that was cut anywhere: several small files and a large one of many splits."""
    records = [f"<page><title>{i}</title>{'x' * (i * 37 % 3000)}</page>" for i in range(1500)]
    parts = [records[:3], records[3:4], [], records[4:1400], records[1400:]]
    for number, part in enumerate(parts):
        with opener(tmp_path / f"{number}.xml{suffix}", "wb") as file:
            file.write(("end of another</page>\n" + "\n".join(part) + "\n<page>cut").encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        scan = lr.read_tagged_records(spark, str(tmp_path))
        got = [row["rec"] for row in scan.collect()]
        again = scan.coalesce(1).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got) == sorted(records) and len(again) == len(records)
    # It is a table of the caller's session.
    assert scan.sparkSession is spark
    scan.createOrReplaceTempView("scanned")
    assert spark.sql("SELECT count(*) FROM scanned").first()[0] == len(records)


def test_other_tags(spark, tmp_path):
    path = tmp_path / "x.txt"
    path.write_text("[doc]1[/doc]junk[doc]2[/doc]")
    got = lr.read_tagged_records(spark, str(path), "[doc]", "[/doc]").collect()
    assert sorted(row["rec"] for row in got) == ["[doc]1[/doc]", "[doc]2[/doc]"]


def test_html_links(spark):
    html = '<title>A &amp; B</title><a href="/x y">x</a><a href="">e</a><a href="http://h/?a&amp;b">'
    rows = spark.createDataFrame([(html,), ("<a href='/q'>",)], "html string")
    got = lr.html_edges(rows).collect()
    assert sorted(tuple(row) for row in got) == [("A_&_B", "/x_y"), ("A_&_B", "http://h/?a&b")]


def test_dump_to_top_pages_keeps_what_it_stores(spark, tmp_path):
    links = {"A": "BC", "B": "C", "C": "A", "D": "CZ", "E": "EAD", "F": "A"}
    pages = [page(f"<title>{t}</title>", text="<text>" + "".join(f"[[{x}]]" for x in to) + "</text>")
             for t, to in links.items()]
    (tmp_path / "dump.xml").write_text("<mediawiki>" + "\n".join(pages) + page(ns="<ns>2</ns>"))
    work = str(tmp_path / "work")
    top = lr.dump_to_topk(spark, str(tmp_path / "dump.xml"), 3, 3, work)
    assert [row["title"] for row in top.collect()] == ["C", "A", "B"]
    counters = {r["metric"]: r["value"] for r in lr.read_counters(spark, f"{work}/counters").collect()}
    assert (counters["TOTAL_PAGES"], counters["NOT_ARTICLE"]) == (7, 1)
    assert (counters["VERTICES"], counters["EDGES"]) == (6, 10)
    assert lr.graph_summary(lr.read_graph(spark, f"{work}/graph")).first()["edges"] == 10
    assert lr.read_ranks(spark, f"{work}/ranks", 4).count() == 6
