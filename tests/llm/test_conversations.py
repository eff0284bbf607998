"""The prefix trie against a plain version, with the top and the shards made small."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkrank.llm.conversations import conversation_nodes, conversation_turns, subtree_sums
from linkrank.llm.perfect_hash import PerfectHash

SCHEMA = "conv_id long, turn int, role string, text string, depth string, last string, bytes int"


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r, x) for *_, r, x in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - int(np.fmod(c, 5))
        built[c] = tuple(own.get(donor, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in sorted(built.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out, totals = [], {}
    for node in sorted(members, key=len, reverse=True):
        here = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        totals[node] = (sum(totals[k][0] for k in children[node]) or 1, here + sum(totals[k][1] for k in children[node]))
        ends = ",".join(str(c) for c in members[node] if built[c] == node)
        out.append((members[node][0], len(node), members[node[:-1]][0] if node else None, len(members[node]),
                    len(children[node]), *totals[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def made():
    draw, rows = np.random.default_rng(41), []
    for conv in [*range(60), -3, -5, -4, 1003, 2**40]:
        for turn in range(int(draw.integers(1, 11))):
            rows.append((conv, turn, "user" if turn % 2 else "assistant", f"t{draw.integers(0, 2)}é" * int(draw.integers(1, 3))))
    # A common start, copies, one very long conversation and its copy, ties, nulls.
    for conv in range(100, 160):
        rows += [(conv, t, "user", ("common" * 5, "second", f"own {conv % 7}")[t]) for t in range(3)]
    for conv in (300, 305):
        rows += [(conv, t, "a", f"long {t}") for t in range(700)]
    rows += [(310, None, None, None), (310, 1, "x", ""), (310, 1, "w", "tie"), (310, 1, "w", "tie"), (310, -2, "y", "z" * 50_000)]
    rows += [(None, 0, "user", "nobody"), (402, 0, None, "x"), (402, 0, "", "x")]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize(("members", "segments"), [(100_000, 200_000), (5, 10), (1, 3), (40, 1)])
def test_equals_a_plain_version(spark, members, segments):
    rows = made()
    got = conversation_nodes(table(spark, rows).repartition(5), members, segments)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)


def test_small_tables(spark):
    assert conversation_nodes(table(spark, [])).count() == 0
    for rows in ([(5, 0, "a", "b")], [(7, 0, "a", "b")], [(1, 0, "a", "b"), (2, 0, "a", "b")], [(None, 0, "a", "b")]):
        assert sorted(map(tuple, conversation_nodes(table(spark, rows)).collect()), key=repr) == (plain(rows) if rows[0][0] else [])


def test_roles_and_texts_do_not_run_together(spark):
    turns = conversation_turns(table(spark, [(1, 0, "ab", "c"), (1, 1, "a", "bc"), (1, 2, "", "abc")]))
    assert turns.select(F.count_distinct("what")).first()[0] == 3


def test_perfect_hash():
    draw = np.random.default_rng(42)
    for count in (0, 1, 2, 17, 5000):
        keys = draw.integers(0, 1 << 63, (count, 2)).astype(np.uint64)
        hashed = PerfectHash(keys)
        assert sorted(hashed.find(keys).tolist()) == list(range(count))
        strange = draw.integers(0, 1 << 63, (1000, 2)).astype(np.uint64)
        assert (hashed.find(strange) == -1).all()
        half = keys.copy()
        half[:, 1] += np.uint64(1)
        assert (hashed.find(half) == -1).all()
    with pytest.raises(ValueError, match="repeat"):
        PerfectHash(np.ones((2, 2), np.uint64))


def test_sums_run_up_to_the_heads():
    keys = np.arange(1, 13).reshape(6, 2).astype(np.uint64)
    parents = np.stack([np.array([99, 99]), keys[0], keys[0], keys[1], keys[3], np.array([98, 98])]).astype(np.uint64)
    depths = np.array([1, 2, 2, 3, 4, 7])
    (sums,), heads = subtree_sums(keys, parents, depths, np.array([1, 10, 100, 1000, 10_000, 5]))
    assert sums.tolist() == [11_111, 11_010, 100, 11_000, 10_000, 5] and heads.tolist() == [True, False, False, False, False, True]
