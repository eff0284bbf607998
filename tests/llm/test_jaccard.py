"""The similarity join's index: linear in a set's size, and no similar pair lost."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkrank.llm import jaccard

RULES = [Fraction(4, 5), Fraction(9, 10)]


def bands_for(largest, least, sets):
    return [jaccard.Band(i, low, high, *jaccard.allocate(high, low, least, sets))
            for i, (low, high) in enumerate(jaccard.size_bands(largest, least))]


def keys_of(sets, bands, least):
    found = [[] for _ in sets]
    for of, keys in jaccard._entries(np.concatenate(sets), np.array([len(s) for s in sets]), bands, least):
        for o, key in zip(of.tolist(), keys.tolist(), strict=True):
            found[o].append(key)
    return found


def drawn(draw, size):
    return np.sort(draw.integers(0, 1 << 63, size).astype(np.uint64))


@pytest.mark.parametrize("least", RULES)
@pytest.mark.parametrize("sets", [100, 10**6, 10**10])
def test_at_most_two_entries_a_shingle(least, sets):
    draw, bands = np.random.default_rng(20), bands_for(25_000, least, sets)
    for size in [*range(50, 400, 7), 500, 1000, 2000, 3333, 5000, 8000, 12_000, 20_000]:
        for keys in keys_of([drawn(draw, size) for _ in range(3)], bands, least):
            assert len(keys) <= 2 * size, (size, len(keys))


@pytest.mark.parametrize("least", RULES)
@pytest.mark.parametrize("sets", [100, 10**9])
def test_similar_pairs_share_a_key(least, sets):
    """Pairs at the limit: what differs is left out, put in, or both."""
    draw, bands = np.random.default_rng(21), bands_for(9000, least, sets)
    sizes = [*range(1, 60), *range(60, 600, 23), 1000, 5100, 7000]
    for size in sizes:
        for put_in in (0.0, 0.5, 1.0):
            base = drawn(draw, size)
            rest = int(size * (1 - least) / least) if put_in == 1 else int(size * (1 - least))
            new = round(rest * put_in)
            other = np.sort(np.concatenate([draw.permutation(base)[rest - new:], drawn(draw, new)]))
            common = len(np.intersect1d(base, other))
            while common < least * (len(base) + len(other) - common):
                # Too far apart by rounding: take a strange member out again.
                other = other[np.isin(other, base) | (np.cumsum(~np.isin(other, base)) > 1)] if new else base
                new, common = max(0, new - 1), len(np.intersect1d(base, other))
            one, two = keys_of([base, other], bands, least)
            assert set(one) & set(two), (size, put_in)


def test_thin_sets_still_meet():
    """Sets whose parts are nearly all empty: their least shingles are keys."""
    least, band = Fraction(4, 5), jaccard.Band(0, 4, 40, 11, 0)
    draw = np.random.default_rng(22)
    for size in range(5, 41):
        base = drawn(draw, size)
        differ = size // 5
        one, two = keys_of([base, np.sort(draw.permutation(base)[differ:])], [band], least)
        assert set(one) & set(two)


@pytest.mark.parametrize("least", RULES)
def test_bitmaps_pass_every_similar_pair(least):
    draw = np.random.default_rng(24)
    apart, whole = least.denominator - least.numerator, least.denominator + least.numerator
    passed = 0
    for size in [*range(1, 40), 64, 100, 300, 1000, 4000]:
        base = drawn(draw, size)
        gone = int(size * (1 - least))
        sets = [base, np.sort(draw.permutation(base)[gone:]), drawn(draw, size)]
        counts = np.array([len(s) for s in sets])
        own, maps = jaccard._bitmaps(np.concatenate(sets), counts, least)
        # Their common band: the smaller set's.
        one, two, other = (np.frombuffer(m[o - min(own)], "<u8") for m, o in zip(maps, own, strict=True))
        def may(a, b, x, y):
            return jaccard._may_be_similar(x, np.array([y]), a, b[None], apart, whole)[0]  # noqa: B023

        assert may(one, two, counts[0], counts[1])
        if len(other) == len(one):
            passed += may(one, other, counts[0], counts[2]) and size > 100
    assert passed == 0


def test_buckets_of_many_blocks(spark, monkeypatch):
    """A key of more sets than a row holds: blocks meet each other."""
    monkeypatch.setattr(jaccard, "BUCKET_SETS", 4)
    rows = [(i, f"{text_of('same', 80)} own{i} end{i}") for i in range(30)] + [(100 + i, text_of(f"x{i}", 40)) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, jaccard.similar_documents(df).collect()))
    assert got == brute_force(rows, 3, Fraction(9, 10))


def brute_force(rows, words, least):
    sets = []
    for doc_id, text in rows:
        split = (text or "").lower().split()
        count = max(1, len(split) - words + 1)
        sets.append((doc_id, {tuple(split[i:i + words]) for i in range(count)} if split else set()))
    low = {i: i for i, _ in sets}
    near = [(a, b) for a, x in sets for b, y in sets if x and y and a != b and len(x & y) >= least * len(x | y)]
    changed = True
    while changed:
        changed = False
        for a, b in near:
            if low[a] < low[b]:
                low[b], changed = low[a], True
    return sorted((i, len(s), low[i]) for i, s in sets)


def text_of(name, count):
    return " ".join(f"{name}v{i}" for i in range(count))


@pytest.mark.parametrize(("words", "least"), [(5, Fraction(4, 5)), (3, Fraction(9, 10))])
def test_long_sets_equal_brute_force(spark, words, least):
    draw, rows = np.random.default_rng(23), []
    for group, count in enumerate([6000, 5500, 900, 60, 12]):
        base = [f"g{group}v{i}" for i in range(count)]
        for copy in range(6):
            made = [*base, *(f"g{group}c{copy}x{i}" for i in range(int(count * draw.uniform(0, 0.3))))]
            for at in draw.permutation(count)[:int(count * draw.uniform(0, 0.02))].tolist():
                made[at] = f"y{copy}"
            rows.append((100 * group + copy, " ".join(made)))
    # Unrelated texts that share a passage stay apart.
    passage = text_of("p", 60)
    rows += [(1000 + i, f"{text_of(f'u{i}', 300)} {passage}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, jaccard.similar_documents(df, words, least).collect()))
    assert got == brute_force(rows, words, least)


def test_repeated_ids_keep_all_links(spark):
    a, b, c = text_of("a", 30), text_of("b", 40), text_of("c", 20)
    rows = [(1, a), (1, b), (2, a), (3, b), (4, c), (5, c), (6, c), (6, ""), (5, None), (7, ""), (7, a), (8, c), (8, c), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.similar_documents(df).collect()}
    assert {i: got[i, n] for i, n in got if n} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4, 7: 1, 8: 4}
    assert got[6, 0] == 4 and got[5, 0] == 4 and got[7, 0] == 1 and got[9, 0] == 9
    kept = sorted((r.doc_id, r.text or "") for r in jaccard.keep_one_of_each(df).collect())
    assert kept == [(1, a), (1, b), (4, c), (5, ""), (6, ""), (7, ""), (9, "")]


def test_one_row_of_each_group_stays(spark):
    a, b = text_of("a", 30), text_of("b", 30)
    rows = [(3, a, "x"), (3, a, "y"), (4, a, "x"), (None, a, "x"), (5, b, "x"), (5, a, "x"), (6, b, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, class string")
    kept = jaccard.keep_one_of_each(df)
    assert kept.columns == df.columns
    left = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert left == sorted([(3, a), (None, a), (5, b)], key=repr)
    assert jaccard.keep_one_of_each(df.where(F.lit(False))).count() == 0
