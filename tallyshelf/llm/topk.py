"""Exact top-k by inner product, with vectors grouped by length."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# Ratio of lengths inside a bucket; rows of a bucket's block and of a block of queries.
BAND = 1.05
BLOCK = 4096
QUERY_BLOCK = 1024
# The longest vectors, against which every query gets its first bound.
PROBES = 1024
# Local cosine thresholds from here on prune by coordinates, lower ones by length alone.
COORDINATES_FROM = 0.6
FOCUS = 4
_LONG = (1 << 63) - 1


def quantised(vectors: DataFrame, id_column: str, vector_column: str, scale: float = 64.0) -> DataFrame:
    """(vec_id, codes, norm): components floor(scale * x), of the vectors that have only finite ones.

    Null vectors and ids are left out. Of rows that share an id the least vector counts.
    """
    x = F.transform(F.col(vector_column), lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    codes = vectors.filter(F.col(vector_column).isNotNull() & F.col(id_column).isNotNull() & finite).select(
        F.col(id_column).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale)).alias("codes")
    )
    squares = F.aggregate("codes", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    return codes.groupBy("vec_id").agg(F.min("codes").alias("codes")).withColumn("norm", F.sqrt(squares))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of codes; shorter vectors count as ending in zeros."""
    rows = column.to_pylist()
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


def _width(*columns: pa.ChunkedArray | pa.Array) -> int:
    return max((len(r) for c in columns for r in c.to_pylist()), default=0)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; what a long can't hold is its nearest long."""
    most = int(np.abs(a.astype(float)).max(initial=0)) * int(np.abs(b.astype(float)).max(initial=0)) * max(1, a.shape[1])
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.array([[max(-_LONG - 1, min(_LONG, int(x))) for x in row] for row in exact], np.int64).reshape(len(a), len(b))


def _best(scores: np.ndarray, ids: np.ndarray, k: int, least: float) -> np.ndarray:
    """Places of the k highest scores of at least ``least``, ties to smaller ids."""
    held = np.flatnonzero(scores >= least)
    if len(held) > k:
        bar = np.partition(scores[held], len(held) - k)[len(held) - k]
        held = held[scores[held] >= bar]
    return held[np.lexsort((ids[held], -scores[held]))][:k]


def _survivors(unit: np.ndarray, query: np.ndarray, cosine: float) -> np.ndarray:
    """Rows whose coordinates allow that cosine with the unit query, judged at its largest coordinates."""
    rest = math.sqrt(max(0.0, 1 - cosine * cosine))
    held = np.arange(len(unit))
    for f in np.argsort(-np.abs(query))[:FOCUS]:
        q = float(query[f])
        middle, half = q * cosine, rest * math.sqrt(max(0.0, 1 - q * q)) + 1e-9
        low = -1.0 if q <= -cosine else middle - half
        high = 1.0 if q >= cosine else middle + half
        values = unit[held, f]
        held = held[(values >= low - 1e-9) & (values <= high + 1e-9)]
    return held


def search_block(queries: pa.Table, block: pa.Table, k: int) -> pa.Table:
    """Each query's k best of a block of one bucket: (query_id, vec_id, score), none below the query's bound.

    The bound over the query's and the bucket's largest length is the cosine
    that a product must reach here. Above 1 nothing can; if high, coordinates
    prune; else candidates too short to reach the bound are cut off. What is
    left is verified by exact products.
    """
    width = _width(queries["codes"], block["codes"])
    q, c = _matrix(queries["codes"], width), _matrix(block["codes"], width)
    norms = block["norm"].to_numpy()
    order = np.argsort(-norms, kind="stable")
    c, norms, ids = c[order], norms[order], block["vec_id"].to_numpy()[order]
    unit = c / np.maximum(norms, 1e-300)[:, None]
    lengths, bounds, names = queries["norm"].to_numpy(), queries["bound"].to_numpy(), queries["vec_id"].to_numpy()
    out: list[tuple[int, np.ndarray, np.ndarray]] = []
    by_length: list[tuple[int, int]] = []
    # Products are whole numbers: half a unit covers the rounding of lengths.
    slack = bounds - 0.5
    with np.errstate(divide="ignore", invalid="ignore"):
        cosines = np.where(slack > 0, slack / (lengths * norms[0] * (1 + 1e-9)), -1.0)
    for i, cosine in enumerate(cosines):
        if cosine > 1 or np.isnan(cosine):
            continue
        if cosine < COORDINATES_FROM:
            # Sorted by length: a prefix is long enough.
            reach = len(c) if slack[i] <= 0 else int(np.searchsorted(-norms, -slack[i] / (lengths[i] * (1 + 1e-9)), side="right"))
            if reach:
                by_length.append((i, reach))
            continue
        held = _survivors(unit, q[i] / lengths[i], float(cosine))
        held = held[ids[held] != names[i]]
        if len(held):
            scores = products(q[i:i + 1], c[held])[0]
            top = _best(scores, ids[held], k, bounds[i])
            out.append((names[i], ids[held][top], scores[top]))
    for at in range(0, len(by_length), 128):
        part = by_length[at:at + 128]
        reach = max(r for _, r in part)
        scores = products(q[[i for i, _ in part]], c[:reach])
        for row, (i, _) in zip(scores, part):
            held = np.flatnonzero(ids[:reach] != names[i])
            top = held[_best(row[held], ids[held], k, bounds[i])]
            out.append((names[i], ids[top], row[top]))
    counts = [len(v) for _, v, _ in out]
    columns = [
        np.repeat(np.array([n for n, _, _ in out], np.int64), counts),
        *(np.concatenate([x[j] for x in out]) if out else np.zeros(0, np.int64) for j in (1, 2)),
    ]
    return pa.table(columns, names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query among all other rows.

    ``vectors`` and ``queries`` have vec_id (unique), codes and norm. Vectors
    fall into buckets of about equal length, long buckets into blocks by a hash
    of the id, so vectors that are all alike are spread as well. The longest
    vectors give every query a first bound; a query goes only to buckets long
    enough to reach it, in blocks of queries. Fewer than k candidates give all
    of them. Ties go to the smaller id. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    all_rows = stored(vectors.withColumn(
        "band", F.when(F.col("norm") > 0, F.floor(F.log("norm") / math.log(BAND))).otherwise(-1).cast("int")
    ), "vectors")
    bands = all_rows.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest")).collect()
    # Lengths are finite doubles: some ten thousand bands at the very most.
    if not bands:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    blocks = spark.createDataFrame([(b["band"], max(1, -(-b["n"] // BLOCK))) for b in bands], "band int, blocks long")
    probes = all_rows.orderBy(F.desc("norm"), "vec_id").limit(PROBES).toArrow()  # PROBES rows
    probe_ids = probes["vec_id"].to_numpy()
    probe_codes = probes["codes"].combine_chunks()

    @F.arrow_udf("double")
    def first_bound(names: pa.Array, codes: pa.Array) -> pa.Array:
        """A score that k candidates are known to reach."""
        if not len(names):
            return pa.array([], pa.float64())
        width = _width(codes, probe_codes)
        scores = products(_matrix(codes, width), _matrix(probe_codes, width)).astype(object)
        scores[names.to_numpy()[:, None] == probe_ids[None, :]] = -_LONG - 1
        if len(probe_ids) <= k:
            return pa.array([-math.inf] * len(names), pa.float64())
        # The next float below: a score's double may be rounded up.
        return pa.array([np.nextafter(float(sorted(row)[-k]), -math.inf) for row in scores], pa.float64())

    asked = stored(queries.withColumn("bound", first_bound("vec_id", "codes")), "queries")
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    placed = all_rows.join(F.broadcast(blocks), "band").withColumn(
        "block", F.pmod(F.xxhash64("vec_id"), F.col("blocks"))
    ).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    # A query meets a bucket only where its bound can be reached there.
    buckets = F.array(*[
        F.struct(F.lit(b["band"]).alias("band"), F.lit(max(1, -(-b["n"] // BLOCK))).cast("long").alias("blocks"),
                 F.lit(b["longest"]).alias("longest"))
        for b in bands
    ])
    reached = F.filter(buckets, lambda b: (F.col("bound") <= 0.5) | (
        F.col("norm") * b["longest"] * (1 + 1e-9) >= F.col("bound") - 0.5
    ))
    keys = ["band", "block", "part"]
    sent = asked.select(
        "vec_id", "codes", "norm", "bound", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int").alias("part"),
        F.explode(reached).alias("bucket"),
    ).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bucket.blocks") - 1)))
    sent = sent.select(F.col("bucket.band").alias("band"), "block", "part", "vec_id", "codes", "norm", "bound")
    placed = placed.select(*keys, "vec_id", "codes", "norm")

    def searched(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table([np.zeros(0, np.int64)] * 3, names=["query_id", "vec_id", "score"])
        return search_block(left, right, k)

    found = sent.groupBy(*keys).cogroup(placed.groupBy(*keys)).applyInArrow(
        searched, "query_id long, vec_id long, score long"
    )
    line = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(line)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
