"""Title and link rules, against written-out cases and plain Python models."""

from __future__ import annotations

import re
from html.entities import name2codepoint

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkrank.functions import log_add, normalize_title, page_links, safe_ln, unescape_entities

LINK_CASES = {
    "[[Foo Bar]]": ["Foo_Bar"],
    "[[Foo|label]]": ["Foo"],
    "[[E#h|z]]": ["E"],
    "[[#sec|here]]": [],
    "[[]]": [],
    "[[|x]]": [],
    "[[File:x.png]]": [],
    "[[G|a:b]]": [],
    "[[a [[b]] c]]": ["a_[[b"],
    "[[Foo\nBar]]": ["Foo\nBar"],
    "[[ Foo]]": ["_Foo"],
    "[[C&#39;s]]": ["C&"],
    "[[A &amp; B]]": ["A_&_B"],
    "[[A &amp;lt; B]]": ["A_&lt;_B"],
    "[[D &eacute;]]": ["D_é"],
    "[[open": [],
    "[[a]] [[a]] [[b]]": ["a", "a", "b"],
    "[[a]]]] [[b]]": ["a", "b"],
    "[[a]] [[open [[b]]": ["a", "open_[[b"],
    "": [],
    "no links": [],
}

ENTITY_CASES = {
    "plain": "plain",
    "a & b": "a & b",
    "&amp;&lt;&gt;&quot;": "&<>\"",
    "&amp;lt;": "&lt;",
    "&apos;": "&apos;",
    "&unknown;": "&unknown;",
    "&amp": "&amp",
    "&;": "&;",
    "&#;": "&#;",
    "&#x;": "&#x;",
    "&#65;&#x42;&#X43;": "ABC",
    "&#00065;": "A",
    "&#x0041;": "A",
    "&#65535;&#65536;": "￿&#65536;",
    "&#x10000;": "&#x10000;",
    "&#12345678901234567890;": "&#12345678901234567890;",
    "&#6a;": "&#6a;",
    "&#xG;": "&#xG;",
    "&a &amp; b;": "&a & b;",
    "&&amp;": "&&",
    "&eacute;&Eacute;&euro;": "éÉ€",
    "&#55357;&#56832;": "😀",
    "&#xD83D;&#xDE00;": "😀",
    "&#55357;": "?",
    "&#56832;&#55357;": "??",
    "&#55357;&#55357;&#56832;&#56832;": "?😀?",
    "&#55357;x&#56832;": "?x?",
    "&#70000;&#55357;&#70000;": "&#70000;?&#70000;",
    "😀 &amp; ü": "😀 & ü",
}


def one_column(spark, texts, expression):
    rows = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, text string")
    out = rows.select("i", expression(F.col("text")).alias("out")).collect()
    return [row["out"] for row in sorted(out, key=lambda row: row["i"])]


def test_link_cases(spark):
    assert one_column(spark, list(LINK_CASES), page_links) == list(LINK_CASES.values())


def test_entity_cases(spark):
    assert one_column(spark, list(ENTITY_CASES), unescape_entities) == list(ENTITY_CASES.values())


def test_every_named_entity_decodes(spark):
    names = sorted(name2codepoint)
    assert len(names) == 252
    got = one_column(spark, [f"x&{name};y" for name in names], unescape_entities)
    assert got == [f"x{chr(name2codepoint[name])}y" for name in names]


def test_null_stays_null_and_long_runs_decode(spark):
    long_run = "&#65;" * 50_000
    got = one_column(spark, [None, long_run, "&" * 50_000, "x" * 200_000 + "&lt;"], normalize_title)
    assert got == [None, "A" * 50_000, "&" * 50_000, "x" * 200_000 + "<"]


def test_large_bodies_take_linear_time(spark):
    bodies = ["[[" * 300_000, "[[a]]" + "[[" * 300_000, "[[a]]" * 100_000, "x" * 3_000_000 + "[[b]]",
              "[[" + "y" * 2_000_000 + "]]", "]" * 1_000_000]
    got = one_column(spark, bodies, page_links)
    assert [len(links) for links in got] == [0, 1, 100_000, 1, 1, 0]
    assert got[4] == ["y" * 2_000_000]


def test_normalising_replaces_each_space(spark):
    assert one_column(spark, ["a  b&nbsp;c &amp; d"], normalize_title) == ["a__b c_&_d"]


def model_unescape(text):
    def decode(match):
        content = match.group(1)
        if content in name2codepoint:
            return chr(name2codepoint[content])
        number = re.fullmatch(r"#([0-9]+)|#[xX]([0-9a-fA-F]+)", content)
        if number:
            value = int(number.group(1)) if number.group(1) else int(number.group(2), 16)
            if value <= 0xFFFF:
                return chr(value)
        return match.group(0)

    units = re.sub(r"&([^&;]*);", decode, text)
    # Join surrogate pairs, replace single halves.
    return re.sub("[\ud800-\udfff]", "?", units.encode("utf-16", "surrogatepass").decode("utf-16", "surrogatepass"))


def model_links(body):
    links, start = [], 0
    while (start := body.find("[[", start)) >= 0:
        end = body.find("]]", start + 2)
        if end < 0:
            break
        link = body[start + 2:end]
        if ":" not in link:
            target = link.partition("|")[0].partition("#")[0]
            if target:
                links.append(model_unescape(target).replace(" ", "_"))
        start = end + 1
    return links


PIECES = ["[[", "]]", "[", "]", "|", "#", ":", "a", "B c", "\n", "&amp;", "&", ";", "&#233;", "&#x41;",
          "&lt;", "&#55357;", "&#56832;", "é", "😀", "&#", "x41;", "&nope;"]
texts = st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), min_size=40, max_size=40)
few = settings(max_examples=12, deadline=None, database=None, derandomize=True,
               suppress_health_check=list(HealthCheck))


@few
@given(texts)
def test_links_equal_a_plain_scan(spark, bodies):
    assert one_column(spark, bodies, page_links) == [model_links(body) for body in bodies]


@few
@given(texts)
def test_entities_equal_a_plain_scan(spark, bodies):
    assert one_column(spark, bodies, unescape_entities) == [model_unescape(b) for b in bodies]


def test_log_add_and_safe_ln(spark):
    inf = float("inf")
    rows = [(0.0, 0.0, 0.6931471805599453), (-inf, 1.5, 1.5), (1.5, -inf, 1.5), (-inf, -inf, -inf),
            (-1000.0, -1000.0, -999.3068528194401), (-1.0, -800.0, -1.0), (-800.0, -1.0, -1.0)]
    df = spark.createDataFrame(rows, "a double, b double, want double")
    for row in df.withColumn("got", log_add(F.col("a"), F.col("b"))).collect():
        assert row["got"] == pytest.approx(row["want"])
    got = spark.createDataFrame([(0.0,), (1.0,)], "x double").select(safe_ln(F.col("x"))).collect()
    assert [row[0] for row in got] == [-inf, 0.0]
