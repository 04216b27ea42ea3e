"""Centroid clustering against all distances in Python's numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from dimloom.llm import centroids as C

SCHEMA = "vec_id long, embedding array<double>, cluster string, v int"


def plain(rows, k, rounds, dims, seed="2"):
    kept = [(i, [math.floor(256 * x) for x in e]) for i, e in rows
            if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        near = assign()
        for j in range(len(cents)):
            mine = [v for (_, v), (_, c) in zip(kept, near, strict=True) if c == j]
            if mine:
                cents[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    near = assign()
    inertia = {j: sum(d for d, c in near if c == j) for j in range(len(cents))}
    clip = lambda x: x if x < 1 << 63 else None
    return sorted(((i, c, clip(d), clip(inertia[c]) if all(clip(e) is not None for e, b in near if b == c) else None, cents[c])
                   for (i, _), (d, c) in zip(kept, near, strict=True)), key=str)


@pytest.mark.parametrize(("n", "k", "spread", "dims"), [(300, 40, 1.0, 3), (200, 25, 0.01, 4), (60, 40, 1e6, 2), (5, 40, 1.0, 2), (40, 7, 1e12, 3)])
def test_clusters_equal_plain(spark, n, k, spread, dims):
    """Coarse grids make ties and equal centroids; large components need more than 64 bits."""
    rng = random.Random(n)
    rows = [(i, [round(rng.gauss(0, 1), 1) * spread for _ in range(dims)]) for i in range(n)]
    rows += [(None, [0.5] * dims), (1, [0.25] * dims), (n, [0.5] * (dims - 1)), (n + 1, None), (n + 2, [float("nan")] + [0.0] * (dims - 1)),
             (n + 3, [None] + [0.0] * (dims - 1)), (n + 4, [float("inf")] * dims)] + [(5000 + i, [0.125] * dims) for i in range(n // 3)]
    table = spark.createDataFrame([(i, e, "x", 1) for i, e in rows], SCHEMA).repartition(5)
    got = sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.centroid) for r in C.cluster(table, k, 3, dims).collect()), key=str)
    assert got == plain(rows, k, 3, dims)


@pytest.mark.parametrize("dims", [2, 8, 64])
def test_search_equals_all_distances_and_prunes(dims):
    rng = np.random.default_rng(dims)
    centroids = np.concatenate([rng.integers(-300, 300, (200, dims)), np.zeros((3, dims), np.int64)])
    vectors = np.concatenate([rng.integers(-300, 300, (500, dims)), centroids[:50], (centroids[:50] + centroids[50:100]) // 2])
    tree = C.build_tree(centroids)
    assert sorted(m for node in tree for m in (node.members or (node.vantage,))) == list(range(203))
    number, best = C.nearest(vectors, centroids, tree)
    away = C.squared(vectors, centroids)
    assert (best == away.min(axis=1)).all() and (number == away.argmin(axis=1)).all()
    if dims == 2:
        opened = []
        squared = C.squared
        C.squared = lambda a, b: opened.append(len(a) * len(b)) or squared(a, b)
        try:
            C.nearest(vectors, centroids, tree)
        finally:
            C.squared = squared
        assert sum(opened) < 0.3 * away.size


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    out = C.cluster(empty)
    assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
