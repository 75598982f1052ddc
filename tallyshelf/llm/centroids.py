"""Centroid clustering of integer vectors, pruned by Ptolemy's inequality."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

# Pivot pairs are fixed; their vectors come from this many kept vectors, the first by hash. They change the work, not the result.
PIVOT_PAIRS = 4
PIVOT_SAMPLE = 512
# Components beyond this have no squared distance that fits in a long.
LARGEST = 1 << 27
_ROWS = 4096
# Rounding of a bound: a few units in the last place of its terms, taken generously.
_SLACK = 1e-13


def quantised(vectors: DataFrame, id_column: str, column: str, scale: float, size: int) -> DataFrame:
    """(vec_id, codes): floor(scale * x) of every component, as long, of the vectors that take part.

    Vectors that are null, have another number of components, or hold a null or
    non-finite one take no part; nor do those with a component of 2 ** 27 or
    more after scaling, as their distances don't fit in a long.
    """
    x = F.col(column)
    fine = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double") * scale) < float(LARGEST))
    return vectors.filter(x.isNotNull() & (F.size(x) == size) & F.coalesce(F.forall(x, fine), F.lit(False))).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("codes"),
    )


def _first(vectors: DataFrame, salt: str, n: int) -> np.ndarray:
    """The ``n`` vectors whose sha256 of salt:vec_id is least, in that order; equal ids by their components, null ids not at all."""
    named = vectors.filter("vec_id IS NOT NULL").withColumn("hash", F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256))
    rows = named.orderBy("hash", "codes").limit(n).collect()
    return np.array([r["codes"] for r in rows], np.int64)


def pivot_pairs(sample: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pivots, their number in pairs): vectors far apart, by the farthest-first rule, paired as found."""
    if not len(sample):
        return sample, np.zeros((0, 2), np.int64)
    chosen = [0]
    least = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < 2 * PIVOT_PAIRS and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    pairs = np.arange(len(chosen) // 2 * 2).reshape(-1, 2)
    return sample[chosen], pairs


def pivot_distances(codes: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances to the pivots, from exact squares."""
    out = np.empty((len(codes), len(pivots)))
    for k, p in enumerate(pivots):
        out[:, k] = np.sqrt(((codes - p) ** 2).sum(axis=1).astype(np.float64))
    return out


def lower_bounds(near: np.ndarray, far: np.ndarray, between: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """For vectors with pivot distances ``near`` and centroids with ``far``: no pair of them is closer than this.

    Ptolemy: d(x, p) * d(c, s) <= d(x, c) * d(p, s) + d(x, s) * d(c, p), for pivots
    p and s, either way round. Every bound is lowered by what rounding can have
    added to it.
    """
    out = np.zeros((len(near), len(far)))
    for p, s in pairs:
        one, two = np.outer(near[:, p], far[:, s]), np.outer(near[:, s], far[:, p])
        bound = (np.abs(one - two) - (one + two) * _SLACK) / between[p, s]
        np.maximum(out, bound * (1 - _SLACK), out=out)
    return out


def nearest(
    codes: np.ndarray, near: np.ndarray, centroids: np.ndarray, far: np.ndarray, between: np.ndarray, pairs: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, its squared distance, squared distances worked out). Ties go to the smaller number.

    The centroid of the least bound is measured first; then every one whose
    bound doesn't exceed that distance, exactly, in integers.
    """
    bound = lower_bounds(near, far, between, pairs)
    first = bound.argmin(axis=1)
    reached = ((codes - centroids[first]) ** 2).sum(axis=1)
    # Squares up to 2 ** 62 turn into doubles with a relative error of 2 ** -53.
    rows, cols = np.nonzero(bound * bound * (1 - _SLACK) <= reached[:, None].astype(np.float64) * (1 + _SLACK))
    exact = ((codes[rows] - centroids[cols]) ** 2).sum(axis=1)
    # Rows come in order, centroids in order inside a row: the first least one of each row.
    order = np.lexsort((cols, exact, rows))
    head = np.concatenate(([True], np.diff(rows[order]) != 0)) if len(order) else np.zeros(0, bool)
    best = order[head]
    return cols[best], exact[best], len(exact) + len(codes)


def _codes(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _cached(vectors: DataFrame, pivots: np.ndarray, size: int) -> DataFrame:
    """The vectors with their distances to the pivots."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = pivot_distances(_codes(batch.column("codes"), size), pivots)
            ends = pa.array(np.arange(len(near) + 1, dtype=np.int32) * len(pivots))
            lists = pa.ListArray.from_arrays(ends, pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("codes"), lists], ["vec_id", "codes", "near"])

    return vectors.mapInArrow(rows, "vec_id long, codes array<long>, near array<double>")


class _Step:
    """One assignment of all vectors to the centroids of a round."""

    def __init__(self, centroids: np.ndarray, pivots: np.ndarray, pairs: np.ndarray):
        self.centroids, self.pivots, self.pairs = centroids, pivots, pairs
        self.far, self.between = pivot_distances(centroids, pivots), pivot_distances(pivots, pivots)

    def of(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes = _codes(batch.column("codes"), self.centroids.shape[1])
        near = _codes(batch.column("near"), len(self.pivots))
        cluster, distance = np.empty(len(codes), np.int64), np.empty(len(codes), np.int64)
        for at in range(0, len(codes), _ROWS):
            part = slice(at, at + _ROWS)
            cluster[part], distance[part], _ = nearest(
                codes[part], near[part], self.centroids, self.far, self.between, self.pairs)
        return codes, cluster, distance


def _sums(cached: DataFrame, step: _Step) -> DataFrame:
    """(cluster, n, sums): a row for each cluster and batch, with exact componentwise sums."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, cluster, _ = step.of(batch)
            found, n = np.unique(cluster, return_counts=True)
            sums = [codes[cluster == c].sum(axis=0) for c in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array(n.astype(np.int64)), pa.array([s.tolist() for s in sums], pa.list_(pa.int64()))],
                ["cluster", "n", "sums"],
            )

    return cached.mapInArrow(rows, "cluster long, n long, sums array<long>")


def _moved(cached: DataFrame, step: _Step) -> np.ndarray:
    """Every non-empty centroid at floor(sum / count) of its vectors; a row for each component reaches the driver."""
    # As decimals: sums of 2 ** 27 over very many rows outgrow a long.
    parts = _sums(cached, step).select("cluster", "n", F.posexplode("sums").alias("k", "x"))
    out = step.centroids.copy()
    for r in parts.groupBy("cluster", "k").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(20,0)")).alias("s")).collect():
        out[r["cluster"], r["k"]] = int(r["s"]) // r["n"]
    return out


def clusters(vectors: DataFrame, k: int = 40, rounds: int = 5, salt: str = "2") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector after ``rounds`` rounds, and the final centroids.

    ``vectors`` has vec_id and codes, integer lists of one size (``quantised``).
    The start are the ``k`` vectors of the least sha256 of ``salt:vec_id``, all
    if there are fewer. A round assigns each vector to the nearest centroid
    (squared Euclidean, ties to the smaller number) and moves non-empty centroids
    to floor(sum / count); then vectors are assigned once more.

    Distances to the pivots are worked out once and stored with the vectors. In
    a round they bound the distance to each centroid from below by Ptolemy's
    inequality over the pivot pairs; centroids whose bound exceeds a distance
    already found are skipped, all others measured exactly. Tasks are sent
    ``k`` centroids and the pivots; they return sums for each cluster, so no
    vector is shuffled and a cluster of any size gathers nowhere.

    Null vec_ids take part but start no cluster; repeated rows each count. An
    empty table, or one of null ids only, gives no rows.
    """
    start = _first(vectors, salt, k)
    if not len(start):
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), start
    size = start.shape[1]
    pivots, pairs = pivot_pairs(_first(vectors, f"pivot {salt}", PIVOT_SAMPLE))
    cached = stored(_cached(vectors, pivots, size), "pivots")
    centroids = start
    for _ in range(rounds):
        centroids = _moved(cached, _Step(centroids, pivots, pairs))
    step = _Step(centroids, pivots, pairs)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, cluster, distance = step.of(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return stored(cached.mapInArrow(rows, "vec_id long, cluster int, distance long"), "clusters"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with cluster_inertia, inertia (sums of distances) and centroid_sha256.

    The sums pass through the driver, a row for each centroid, and are sent back with the digests.
    """
    sums = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    whole = sum(sums.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = assigned.sparkSession.createDataFrame(
        [(n, d, whole, digests[n]) for n, d in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
