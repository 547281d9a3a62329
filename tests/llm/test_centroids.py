"""Heap-bounded clustering against plain Lloyd in Python integers."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from rollcall.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string"


def lloyd(rows, k, rounds, dim, seed=1, scale=64):
    kept = [(i, tuple(math.floor(scale * float(x)) for x in v)) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)
    centre = [q for _, q in named[:k]]
    if not centre:
        return []

    def dist(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assign():
        return [min(range(len(centre)), key=lambda c: (dist(q, centre[c]), c)) for _, q in kept]

    for _ in range(rounds):
        own = assign()
        for c in range(len(centre)):
            mine = [q for (_, q), o in zip(kept, own, strict=True) if o == c]
            if mine:
                centre[c] = tuple(sum(col) // len(mine) for col in zip(*mine, strict=True))
    own = assign()
    d = [dist(q, centre[c]) for (_, q), c in zip(kept, own, strict=True)]
    per = [sum(x for x, o in zip(d, own, strict=True) if o == c) for c in range(len(centre))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre]
    return [(i, o, x, per[o], sum(d), sha[o]) for (i, _), o, x in zip(kept, own, d, strict=True)]


def key(rows):
    return sorted(map(tuple, rows), key=repr)


def vectors(n, dim, seed, scale=0.3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, scale, (7, dim))
    return [[float(np.float32(x)) for x in middle[rng.integers(7)] + rng.normal(0, scale / 3, dim)] for _ in range(n)]


@pytest.mark.parametrize("dim,k,rounds,scale", [(8, 5, 4, 0.3), (3, 6, 6, 0.05), (64, 16, 3, 0.2), (8, 5, 3, 2000.0)])
def test_matches_plain_lloyd(spark, monkeypatch, dim, k, rounds, scale):
    monkeypatch.setattr(centroids, "BLOCK", 40)  # many blocks, so heaps are parted
    rows = [(i * 3 if i % 17 else None, v, i % 3, "x") for i, v in enumerate(vectors(400, dim, dim, scale))]
    rows += [rows[5]] * 60 + [(rows[9][0], rows[10][1], 1, "same id")] + [(7, [0.0] * dim, None, None)]  # copies, one id twice
    bad = [(5000, None, 1, "x"), (5001, [], 1, "x"), (5002, [1.0] * (dim + 1), 1, "x"), (5003, [None] + [1.0] * (dim - 1), 1, "x"),
           (5004, [math.nan] + [1.0] * (dim - 1), 1, "x"), (5005, [math.inf] + [1.0] * (dim - 1), 1, "x")]
    df = spark.createDataFrame(rows + bad, SCHEMA).repartition(3)
    log = []
    out = centroids.cluster_vectors(df, k=k, rounds=rounds, dim=dim, log=log)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert key(out.collect()) == key(lloyd([r[:2] for r in rows], k, rounds, dim))
    assert log[0] == len(rows) and all(n <= len(rows) for n in log)
    if dim == 64:
        assert sum(log[1:]) < len(rows) * rounds  # gaps that hold are not looked at again


def test_fewer_vectors_than_centroids_ties_and_empty(spark):
    rows = [(1, [1.0, 0.0], 0, ""), (2, [1.0, 0.0], 0, ""), (3, [0.0, 1.0], 0, "")]
    out = centroids.cluster_vectors(spark.createDataFrame(rows, SCHEMA), k=16, rounds=3, dim=2)
    assert key(out.collect()) == key(lloyd([r[:2] for r in rows], 16, 3, 2))
    assert centroids.cluster_vectors(spark.createDataFrame([], SCHEMA), dim=2).collect() == []
    assert centroids.cluster_vectors(spark.createDataFrame([(None, [1.0, 2.0], 0, "")], SCHEMA), dim=2).collect() == []


def test_huge_components_are_clamped(spark):
    rows = [(i, [x, 1.0], 0, "") for i, x in enumerate([3e38, -3e38, 1e30, 5.0])]
    out = centroids.cluster_vectors(spark.createDataFrame(rows, SCHEMA), k=2, rounds=2, dim=2).collect()
    assert len(out) == 4 and all(0 <= r["distance"] < 2**62 for r in out)


def test_popped_vectors_are_those_whose_gap_is_used_up():
    rng = np.random.default_rng(0)
    x = rng.integers(-50, 50, (500, 4))
    block = centroids.Block(x, 6)
    centre, drift = x[:6].copy(), np.zeros(6)
    block.rescan(np.arange(500), centre, drift)
    assert sum(map(len, block.heaps)) == 500 and len(block.expired(drift)) <= 500
    block = centroids.Block(x, 6)
    block.rescan(np.arange(500), centre, drift)
    centre[0] += 3
    step = np.zeros(6)
    step[0] = 6.0
    drift = np.array([step[c] + np.delete(step, c).max() for c in range(6)]) * (1 + 1e-9)
    moved = block.expired(drift)
    held = np.setdiff1d(np.arange(500), moved)
    nearest = centroids.squared_distances(x, centre).argmin(axis=1)
    assert 0 < len(moved) < 500 and (block.cluster[held] == nearest[held]).all()
