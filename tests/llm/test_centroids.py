"""Centroid clustering against plain Lloyd rounds, and the bounds against exact distances."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np

from tallyshelf.llm import centroids, queries

SCHEMA = "vec_id long, embedding array<float>, label int, codes string, near int, cluster string, n long, hash string"


def table(spark, rows):
    return spark.createDataFrame([(i, e, None, None, None, None, None, None) for i, e in rows], SCHEMA)


def plain(rows, k=40, rounds=5):
    kept = []
    for i, e in rows:
        if e is not None and len(e) == 64 and all(x is not None and np.isfinite(x) for x in e):
            kept.append((i, [int(np.floor(256 * np.float64(np.float32(x)))) for x in e]))
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), c) for i, c in kept if i is not None)
    cents = [c for _, c in order[:k]]
    if not cents:
        return []

    def best(c):
        return min((sum((a - b) ** 2 for a, b in zip(c, m)), n) for n, m in enumerate(cents))

    for _ in range(rounds):
        members = {}
        for _, c in kept:
            members.setdefault(best(c)[1], []).append(c)
        for n, own in members.items():
            cents[n] = [sum(col) // len(own) for col in zip(*own)]
    found = [(i, *best(c)[::-1]) for i, c in kept]
    inertia = Counter()
    for _, n, d in found:
        inertia[n] += d
    return [(i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, cents[n])).encode()).hexdigest()) for i, n, d in found]


def rows_of(seed, n, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, 64))
    return [(i, (centres[i % 9] + spread * rng.normal(size=64)).astype(np.float32).tolist()) for i in range(n)]


def check(spark, tmp_path, rows):
    table(spark, rows).write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op12_centroids(spark, str(tmp_path)).collect()
    assert Counter(map(tuple, got)) == Counter(plain(rows))
    return got


def test_query_equals_plain_rounds(spark, tmp_path):
    rows = rows_of(1, 300, 0.3)
    whole = rows[7][1]
    rows += [(1000, None), (1001, whole[:63]), (1002, [None] + whole[1:]), (1003, [float("nan")] + whole[1:]),
             (1004, [float("inf")] + whole[1:]), (1005, []), (None, whole), (7, whole), (1006, [0.0] * 64), (1007, whole + [1.0])]
    got = check(spark, tmp_path, rows)
    assert sum(r.vec_id is None for r in got) == 1 and len(got) == 303


def test_few_equal_and_no_vectors(spark, tmp_path):
    check(spark, tmp_path / "a", rows_of(2, 3))
    check(spark, tmp_path / "b", [(i, [0.5] * 64) for i in range(60)])
    assert check(spark, tmp_path / "c", []) == []
    assert check(spark, tmp_path / "d", [(None, [0.5] * 64), (1, None)]) == []


def test_large_components_take_no_part(spark):
    df = table(spark, [(1, [1e30] * 64), (2, [5e5] * 64), (3, [1.0] * 64)])
    assert [r.vec_id for r in centroids.quantised(df, "vec_id", "embedding", 256.0, 64).orderBy("vec_id").collect()] == [2, 3]


def test_bounds_never_exceed_distances():
    rng = np.random.default_rng(5)
    for scale in (1, 300, 1 << 26):
        sample = rng.integers(-scale, scale + 1, (200, 64))
        sample[::7] = sample[0]
        pivots, pairs = centroids.pivot_pairs(sample)
        assert len(pairs) == centroids.PIVOT_PAIRS
        near, far = centroids.pivot_distances(sample, pivots), centroids.pivot_distances(sample[:40], pivots)
        bound = centroids.lower_bounds(near, far, centroids.pivot_distances(pivots, pivots), pairs)
        exact = ((sample[:, None] - sample[None, :40]) ** 2).sum(axis=2)
        assert (bound * bound <= exact * (1 + 1e-12)).all()


def test_bounds_spare_work_and_lose_nothing():
    rng = np.random.default_rng(6)
    centres = rng.integers(-400, 400, (40, 64))
    codes = centres[rng.integers(0, 40, 3000)] + rng.integers(-30, 30, (3000, 64))
    pivots, pairs = centroids.pivot_pairs(codes[:512])
    args = centroids.pivot_distances(codes, pivots), centres, centroids.pivot_distances(centres, pivots), centroids.pivot_distances(pivots, pivots), pairs
    cluster, distance, measured = centroids.nearest(codes, *args)
    exact = ((codes[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert measured < 0.6 * exact.size
    assert random
