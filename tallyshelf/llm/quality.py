"""Quality classifier from trusted positives and unlabelled texts."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
FEATURES = 9 + len(_MARKS)
# Features further than this many deviations from the mean count as this far.
CLIP = 5.0
BINS = 1000
ROUNDS = 25
_STEPS = (1.0, 0.5, 0.2, 0.05, 0.01)


def features(text: str | None) -> np.ndarray:
    """Shape of a text: sizes, repetition, and shares of kinds of bytes. Words are cut at white space; empty texts are all zero."""
    out = np.zeros(FEATURES, np.float32)
    words = (text or "").split()
    if not words:
        return out
    data = np.frombuffer(text.encode(), np.uint8)
    bytes_ = np.bincount(data, minlength=256)
    size, n = len(data), len(words)
    shares = bytes_[bytes_ > 0] / size
    letters = bytes_[65:91].sum() + bytes_[97:123].sum()
    out[0] = math.log1p(n)
    out[1] = math.log1p(len(text) / n)
    out[2] = len(set(words)) / n
    out[3] = sum(map(str.__eq__, words, words[1:])) / n
    out[4] = bytes_[65:91].sum() / max(1, letters)
    out[5] = bytes_[48:58].sum() / size
    out[6] = bytes_[128:].sum() / size
    out[7] = bytes_[10] / n
    out[8] = -(shares * np.log2(shares)).sum()
    out[9:] = np.sqrt(bytes_[np.frombuffer(_MARKS, np.uint8)] / n)
    return out


@dataclass
class Model:
    """Weights over standardised features, the constant last. ``weights`` None: nothing to learn from."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    prior: float

    def prepared(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) * self.scale, -CLIP, CLIP)
        return np.hstack([z, np.ones((len(x), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.prepared(x) @ self.weights, -40, 40)))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, FEATURES).astype(np.float64)


def _summed(rows: DataFrame, make, width: int) -> np.ndarray:
    """The sum over all rows of what ``make(features, trusted)`` gives for a batch, added up in two levels.

    Each task gives one array and about the square root of so many tasks add
    them up, so the driver gets few arrays of a fixed size.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += make(_matrix(batch.column("x")), batch.column("trusted").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for s in batch.column("sums"):
                total += np.frombuffer(s.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    parts = rows.mapInArrow(first, "sums binary")
    # Dealt out by content, so a task run again deals the same.
    tasks = math.isqrt(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = parts.repartition(max(1, tasks), "sums")
    return sum((np.frombuffer(r["sums"]) for r in dealt.mapInArrow(second, "sums binary").collect()), np.zeros(width))


def _losses(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logistic loss of calling it negative, and its slope."""
    return np.logaddexp(0, z), 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _fit(rows: DataFrame, model: Model, prior: float, ridge: float) -> np.ndarray:
    """Weights of least non-negative risk: prior * E+[l(z)] + max(0, Eu[l(-z)] - prior * E+[l(-z)]), and a ridge.

    Newton steps over all rows. A round tries a few step lengths in one pass and
    takes the best one whose second term is not negative; where none lowers the
    risk it ends, so the term never goes below zero by overfitting.
    """
    d = FEATURES + 1
    base, step = np.zeros(d), np.zeros(d)
    best = math.inf
    ridges = np.full(d, ridge)
    ridges[-1] = 0
    for _ in range(ROUNDS):
        tried = [base + s * step for s in (_STEPS if step.any() else (0.0,))]

        def sums(x: np.ndarray, trusted: np.ndarray, tried=tuple(tried)) -> np.ndarray:
            a = model.prepared(x)
            u, p = a[~trusted], a[trusted]
            out = [[len(u), len(p)]]
            for w in tried:
                loss, slope = _losses(u @ w)
                negative, high = _losses(p @ w)
                hessian = (u * (slope * (1 - slope))[:, None]).T @ u
                out += [[loss.sum(), negative.sum(), (p @ w).sum()], u.T @ slope, p.sum(axis=0), p.T @ high, hessian.ravel()]
            return np.concatenate(out)

        width = 2 + len(tried) * (3 + 3 * d + d * d)
        total = _summed(rows, sums, width)
        n_u, n_p = total[0], total[1]
        found = None
        for k, w in enumerate(tried):
            part = total[2 + k * (3 + 3 * d + d * d):][: 3 + 3 * d + d * d]
            loss_u, loss_p, margin = part[0] / n_u, part[1] / n_p, part[2] / n_p
            negative = loss_u - prior * loss_p
            # l(z) = l(-z) - z for the logistic loss.
            risk = prior * (loss_p - margin) + max(0.0, negative) + 0.5 * float(ridges @ (w * w))
            if negative >= 0 and (found is None or risk < found[0]):
                gradient = part[3:3 + d] / n_u - prior * part[3 + d:3 + 2 * d] / n_p + ridges * w
                hessian = part[3 + 3 * d:].reshape(d, d) / n_u + np.diag(ridges + 1e-9)
                found = risk, w, gradient, hessian
        if found is None or found[0] >= best - 1e-7:
            break
        best, base, gradient, hessian = found
        step = -np.linalg.solve(hessian, gradient)
        if np.abs(step).max() < 1e-4:
            break
    return base


def _estimated_prior(rows: DataFrame, model: Model) -> float:
    """Share of positives among unlabelled texts.

    Above any score the unlabelled hold at least the prior times the share that
    trusted positives have there; the score where that bound, with a margin for
    few rows, is least gives the prior.
    """

    def histogram(x: np.ndarray, trusted: np.ndarray) -> np.ndarray:
        bins = np.minimum((model.score(x) * BINS).astype(np.int64), BINS - 1)
        return np.concatenate([np.bincount(bins[~trusted], minlength=BINS), np.bincount(bins[trusted], minlength=BINS)]).astype(float)

    counts = _summed(rows, histogram, 2 * BINS)
    u, p = (np.cumsum(c[::-1]) for c in (counts[:BINS], counts[BINS:]))
    n_u, n_p = u[-1], p[-1]
    margin = math.sqrt(math.log(40) / (2 * n_u)) + math.sqrt(math.log(40) / (2 * n_p))
    held = p > 0
    bound = (u[held] / n_u + margin) / (p[held] / n_p)
    at = int(np.argmin(bound))
    return float(np.clip((u[held][at] / n_u) / (p[held][at] / n_p), 0.01, 0.99))


def train(docs: DataFrame, labels: DataFrame, fold: Column | None = None, ridge: float = 1e-3) -> Model:
    """A model of trusted positives against unlabelled texts; only rows of ``labels`` where ``fold`` holds are learnt from.

    A document is a trusted positive if all its labels there are 1. Documents
    without a label there are the unlabelled ones (all documents, if every one
    has a label); labels of 0 are not used. Their features are written once,
    and every pass is over all of them. Without positives or documents the
    model scores 0.5.
    """
    used = labels.filter("quality is not null and doc_id is not null")
    used = used.filter(fold) if fold is not None else used
    known = used.groupBy("doc_id").agg((F.min("quality") == 1).alias("trusted"))

    @F.arrow_udf("binary")
    def encoded(texts: pa.Array) -> pa.Array:
        return pa.array([features(t.as_py()).tobytes() for t in texts], pa.binary())

    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), encoded("text").alias("x"))
    every = stored(every, "features").join(known.withColumnRenamed("doc_id", "id"), F.col("doc_id") == F.col("id"), "left")
    rows = stored(every.select("x", "trusted"), "examples")
    counts = rows.agg(F.count(F.lit(1)), F.count_if("trusted"), F.count_if(F.col("trusted").isNull())).first()
    neutral = Model(np.zeros(FEATURES), np.ones(FEATURES), None, 0.5)
    if not counts[0] or not counts[1]:
        return neutral
    positives = rows.filter("trusted")
    others = rows.filter("trusted is null") if counts[2] else rows
    rows = positives.unionByName(others.withColumn("trusted", F.lit(False)))

    def moments(x: np.ndarray, trusted: np.ndarray) -> np.ndarray:
        u = x[~trusted]
        return np.concatenate([[len(u)], u.sum(axis=0), (u * u).sum(axis=0)])

    total = _summed(rows, moments, 1 + 2 * FEATURES)
    mean = total[1:1 + FEATURES] / total[0]
    spread = np.sqrt(np.maximum(total[1 + FEATURES:] / total[0] - mean**2, 0))
    model = Model(mean, np.where(spread > 1e-6, 1 / np.maximum(spread, 1e-6), 0.0), None, 0.5)
    model.weights = _fit(rows, model, 0.5, ridge)
    model.prior = _estimated_prior(rows, model)
    model.weights = _fit(rows, model, model.prior, ridge)
    return model


def quality(text: Column, model: Model) -> Column:
    """Score from 0 to 1 of every text; a null text scores as the empty one."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        if not len(texts):
            return pa.array([], pa.float64())
        return pa.array(model.score(np.stack([features(t.as_py()) for t in texts]).astype(np.float64)))

    return scored(text)


def in_held_out_fold(doc_id: Column | str) -> Column:
    """Every fifth document by the CRC-32 of its id as text; a null id counts as the empty text."""
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(5)) == 0


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, learnt from labels outside the held-out fold.

    Null and repeated doc_ids and repeated rows keep their rows. Other columns,
    such as language and source, are not looked at.
    """
    model = train(docs, labels, ~in_held_out_fold("doc_id"))
    scored = docs.select("doc_id", in_held_out_fold("doc_id").alias("held_out"), quality(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
