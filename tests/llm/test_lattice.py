"""Lattice duplicates with cells and components of several blocks."""

from __future__ import annotations

import numpy as np

from linkrank.llm import lattice

SCHEMA = "vec_id long, embedding array<double>, label int, component string, n_links string, cell int"


def test_cells_of_many_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK_ROWS", 8)
    draw = np.random.default_rng(71)
    base = draw.normal(size=(6, 24))
    vectors = np.concatenate([base[np.arange(180) % 6] + 0.04 * np.abs(draw.normal(size=(180, 1))) * draw.normal(size=(180, 24)) * 4,
                              draw.normal(size=(60, 24))])
    labels = [i % 3 if i % 11 else None for i in range(240)]
    rows = [(i, v.tolist(), label) for i, (v, label) in enumerate(zip(vectors, labels, strict=True))]
    rows += [(500, vectors[1].tolist(), labels[1]), (501, [1.0, 2.0], 1), (502, [2.0, 4.0], 1), (503, [], 1), (504, None, 1)]
    df = spark.createDataFrame([(i, v, label, "clash", "clash", 0) for i, v, label in rows], SCHEMA).repartition(4)
    got = sorted(tuple(r) for r in lattice.near_duplicates(df).collect())
    near = {i: set() for i, *_ in rows}
    for i, v, a in rows:
        for j, w, b in rows:
            if i != j and a is not None and a == b and v and w and len(v) == len(w):
                if np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.93:
                    near[i].add(j)
    low, changed = {i: i for i in near}, True
    while changed:
        changed = False
        for i, others in near.items():
            least = min([low[i], *(low[j] for j in others)])
            low[i], changed = least, changed or least != low[i]
    assert sum(map(len, near.values())) > 1000
    assert got == sorted((i, len(near[i]), low[i], low[i] == i) for i in near)
