"""Base columns of the licence scan against a plain version over a whole table."""

from __future__ import annotations

import os
import re

import pytest

from linkrank.llm.licenses import scan_licenses

PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    found = [(i, label) for i in range(len(words)) for phrase, label in PHRASES.items() if tuple(words[i:i + len(phrase)]) == phrase]
    places = [i for i, _ in found]
    return len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({label for _, label in found}))


def check(docs):
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in scan_licenses(docs).collect()), key=repr)
    assert got == sorted(((r.doc_id, *plain(r.text)) for r in docs.select("doc_id", "text").collect()), key=repr)
    return got


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_base_columns_over_a_whole_table(spark):
    got = check(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    assert any(row[2] for row in got)


def test_base_columns_of_odd_texts(spark):
    texts = ["MIT license mit LICENSE", "mit\tlicense-apache_license", "the mit", "license", None, "", "…mit… license ÀPACHE license",
             "general public public license general public license", "mit license " * 30_000, "MIT\x00License", "mit ﬁ license", "mit license2"]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "mit license", "c"), (3, "apache license", "c"), (3, "apache license", "c")]
    got = check(spark.createDataFrame(rows, "doc_id long, text string, labels string").repartition(3))
    assert len(got) == len(rows)
