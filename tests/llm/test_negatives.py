"""Hard negatives against a plain version, and the vertical scan on its own."""

from __future__ import annotations

import math

import numpy as np
import pytest

from linkrank.llm import negatives
from linkrank.llm.negatives import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, id string, score string, positive string, block int"


def plain(rows, anchors, positives, count, low, high):
    """Rows and anchors are (id, vector, label), each once."""
    def sound(table):
        return {r for r in table if r[0] is not None and r[1] is not None and r[2] is not None
                and all(x is not None and math.isfinite(x) for x in r[1])}

    def score(a, b):
        return sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a[1], b[1], strict=True))

    out, rows = [], sound(rows)
    for a in sound(anchors):
        others = [(-score(a, r), r[0], r[2]) for r in rows if r[0] != a[0] and len(r[1]) == len(a[1])]
        same = sorted((s, i) for s, i, label in others if label == a[2])[:positives]
        for p, positive in same:
            within = sorted((s, i) for s, i, label in others if label != a[2] and low * -p <= 100 * -s <= high * -p)
            out += [(a[0], positive, rank, i, -p, -s) for rank, (s, i) in enumerate(within[:count], 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(
        [(i, None if v is None else list(v), label, "clash", "clash", "clash", 7) for i, v, label in rows], SCHEMA)


def made():
    draw = np.random.default_rng(31)
    base = draw.normal(size=(12, 16)) / 4
    rows = [(i, tuple((base[i % 12] * draw.uniform(0.4, 1) + draw.normal(size=16) / 12).tolist()), int(draw.integers(0, 3)))
            for i in range(150)]
    rows += [(200 + i, rows[0][1], i % 2) for i in range(40)]
    rows += [(300 + i, tuple(x / 2 for x in rows[0][1]), 1 + i % 2) for i in range(30)]
    rows += [(400, None, 1), (401, (math.nan, *[0.0] * 15), 0), (402, (None, *[0.0] * 15), 0), (403, rows[0][1], None),
             (None, rows[0][1], 0), (404, (math.inf, *[0.0] * 15), 0), (405, (0.0,) * 16, 0), (406, (0.0,) * 16, 1),
             (410, (), 0), (411, (), 0), (412, (), 1), (420, (1.0, 2.0), 0), (421, (1.0, 1.5), 0), (422, (0.5, 1.0), 1),
             (430, (1.0, -2.0), 5), (431, (-1.0, 2.0), 5), (432, (-1.0, 2.0), 6)]
    return [*rows, rows[3], rows[3]]


@pytest.mark.parametrize("block_rows", [4096, 20])
def test_equals_a_plain_version(spark, block_rows):
    rows = made()
    asked = [r for r in rows if r[0] is None or r[0] % 5 == 0 or r[0] in (412, 421, 431)]
    got = hard_negatives(table(spark, rows).repartition(4), table(spark, asked), block_rows=block_rows)
    want = plain(rows, asked, 5, 3, 50, 95)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert len(want) > 100 and sorted(map(tuple, got.collect())) == want
    others = hard_negatives(table(spark, rows), table(spark, asked), positives=2, negatives=40, low=10, high=100)
    assert sorted(map(tuple, others.collect())) == plain(rows, asked, 2, 40, 10, 100)


def test_empty_tables(spark):
    none, some = table(spark, []), table(spark, made()[:9])
    for rows, asked in ((none, none), (some, none), (none, some)):
        assert hard_negatives(rows, asked).count() == 0


def test_scan_reads_few_rows_to_the_end():
    """Rows that the first columns rule out are not read further, and none is lost."""
    draw = np.random.default_rng(32)
    vectors = np.rint(draw.normal(size=(3000, 64)) * 30 * 0.9 ** np.arange(64)).astype(np.int64)
    block = negatives.Block(np.arange(3000), np.zeros(3000, np.int64), np.ascontiguousarray(vectors.T).astype(float))
    for query in vectors[:20]:
        sizes = []

        def top(lower, upper, sizes=sizes):
            sizes.append(len(lower))
            return upper >= np.partition(lower, len(lower) - 5)[len(lower) - 5] if len(lower) > 5 else np.ones(len(lower), bool)

        rows, scores = block.scan(query.astype(float), None, top)
        exact = vectors @ query
        assert (exact[rows] == scores).all() and sizes[-1] < 1500
        assert set(np.argsort(-exact, kind="stable")[:5]) <= set(rows.tolist()) or sorted(exact)[-5] in scores
        ids, best = block.best(query.astype(float), -1, 5)
        order = np.lexsort((np.arange(3000), -exact))[:5]
        assert ids.tolist() == order.tolist() and best.tolist() == exact[order].tolist()


def test_scores_beyond_doubles_are_exact(spark):
    big = 2.0 ** 20
    rows = [(1, (big, 1.0), 0), (2, (big, 1.0 + 1 / 256), 0), (3, (big / 2, 0.0), 1), (4, (big / 2, -1 / 256), 1), (5, (big * 0.9, 3.0), 1)]
    got = hard_negatives(table(spark, rows), table(spark, rows[:1]))
    assert sorted(map(tuple, got.collect())) == plain(rows, rows[:1], 5, 3, 50, 95)
    with pytest.raises(ValueError, match="too large"):
        negatives.quantised(np.array([[1e300]]))
