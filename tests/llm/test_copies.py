"""Exact duplicates against a plain version, with clashing hashes and hot groups."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from linkrank.llm.copies import exact_copies

SCHEMA = "doc_id long, text string, kept string, row int, key string, group_size string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(UPPER)].append(doc_id)
    out = []
    for text, ids in groups.items():
        largest = max((i for i in ids if i is not None), default=None)
        sha, left = hashlib.sha256(text.encode()).hexdigest(), 1
        for i in sorted(ids, key=lambda i: i != largest):
            out.append((i, largest, len(ids), i == largest and left == 1, sha))
            left -= i == largest
    return sorted(out, key=repr)


def rows():
    draw = np.random.default_rng(11)
    texts = ["", None, "ÀB c", "àb C", "Àb C", "x" * 400_000, "X" * 400_000, "tie", " tie"]
    texts += [f"t{n}" for n in draw.integers(0, 60, 200)] + ["Hot copy"] * 150
    made = [(i, t) for i, t in enumerate(texts)]
    return [*made, (None, "tie"), (None, "only nulls"), (None, "ONLY nulls"), (7, "tie"), (7, "tie"), (-5, "minus"), (-6, "Minus")]


@pytest.mark.parametrize(("bits", "hot_rows"), [(128, 1_000_000), (128, 20), (4, 1_000_000), (8, 20), (0, 30)])
def test_groups_equal_a_plain_version(spark, bits, hot_rows):
    made = rows()
    docs = spark.createDataFrame([(i, t, "clash", 1, "clash", "clash") for i, t in made], SCHEMA).repartition(5)
    got = exact_copies(docs, bits=bits, hot_rows=hot_rows)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(made)


def test_empty_table(spark):
    assert exact_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_runs_no_python(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "A")], "doc_id long, text string")
    plan = exact_copies(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
