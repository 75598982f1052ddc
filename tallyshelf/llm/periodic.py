"""Periodic runs of words by the dictionary of basic factors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words looked at together: texts are joined up to this many; a longer text is a block of its own.
BLOCK_WORDS = 1 << 19

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _recurring(names: np.ndarray, at: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, distance to the next equal name of its text or 0, has any equal name in its text), by position."""
    order = np.argsort(names, kind="stable")
    same = (names[order[1:]] == names[order[:-1]]) & (text[at[order[1:]]] == text[at[order[:-1]]])
    far, met = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
    far[order[:-1][same]] = (at[order[1:]] - at[order[:-1]])[same]
    met[order[:-1][same]] = True
    met[order[1:][same]] = True
    return at, far, met


def block_runs(ids: np.ndarray, ends: np.ndarray, least: int = 6, times: int = 4) -> np.ndarray:
    """Runs (text, start, length, period) of texts laid end to end, by text, start, period; ``start`` counts from the text's first word.

    ``ids`` numbers the words, equal words alike; text t ends before ``ends[t]``.
    The basic factor of level k at a position is its 2 ** k words; its name is
    made from those of its halves, so equal names are equal factors. Positions
    whose factor stands once in its text are dropped, as all longer factors
    there stand once as well.

    A position's successor is the next one of equal name. Where it is at most
    twice the factor's length away, the distance proposes a period, and
    successive positions of one distance d, whose occurrences are arithmetic
    progressions of that step, are one proposal: first position a, last b. For
    d up to the factor's length L it reaches from a to b + L + d: inside a run of
    smallest period d no factor as long as d has a nearer successor, so that is
    the run's whole extent. A distance above L is proposed again by the next
    level, and one of L / 2 or less was proposed by the level before; each run is
    kept from the one level whose L is the least power of two not below d.
    """
    n = len(ids)
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    text = np.repeat(np.arange(len(ends)), ends - starts)
    limit = ends.astype(np.int64)[text]
    name, at, length = ids.astype(np.int64), np.arange(n, dtype=np.int64), 1
    found = [np.zeros((0, 4), np.int64)]
    while len(at):
        at, far, met = _recurring(name[at], at, text)
        near = (far > length // 2) & (far <= length)
        a, d = at[near], far[near]
        if len(a):
            cut = np.flatnonzero((np.diff(a) != 1) | (np.diff(d) != 0) | (np.diff(text[a]) != 0)) + 1
            first, last = np.concatenate(([0], cut)), np.concatenate((cut, [len(a)])) - 1
            period = d[first]
            size = a[last] - a[first] + length + period
            keep = size >= np.maximum(least, times * period)
            t = text[a[first][keep]]
            found.append(np.stack([t, a[first][keep] - starts[t], size[keep], period[keep]], axis=1))
        # The next level: both halves recur, and the whole lies inside its text.
        alive = np.zeros(n + 1, bool)
        alive[at[met]] = True
        at = at[met]
        at = at[at + 2 * length <= limit[at]]
        at = at[alive[at + length]]
        if len(at):
            pairs = name[at] * (n + 1) + name[at + length]
            renamed = np.full(n, -1, np.int64)
            renamed[at] = np.unique(pairs, return_inverse=True)[1]
            name = renamed
        length *= 2
    rows = np.concatenate(found)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for words in texts for w in words), np.int64)
    return ids, np.cumsum([len(words) for words in texts])


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period."""
    if len(runs):
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, runs[:, 1] + runs[:, 3], 1)
        np.add.at(edges, runs[:, 1] + runs[:, 2], -1)
        words = [w for w, inside in zip(words, np.cumsum(edges).tolist()) if not inside]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """(doc_id, runs, collapsed): the periodic runs of every whole text, and the text without their repetitions.

    Words are cut at ASCII white space and numbered from 0. ``runs`` is a list of
    (start, length, period) by start, then period: stretches of words with that
    smallest period, of at least ``least`` words and ``times`` periods, that no
    neighbouring word extends. ``collapsed`` keeps the words that no run holds
    after its first period, one space between them.

    A text is read where it lies; nothing is shuffled, so copies and hot sources
    gather nowhere. A task holds one block of ``BLOCK_WORDS`` words, or one longer
    text.

    A null text is the empty text: no runs, nothing left. Null and repeated
    doc_ids and repeated rows each keep their row; other columns are ignored; an
    empty table gives no rows.
    """
    if least < 2 or times < 3:
        raise ValueError("a run has at least two words and three periods: a factor as long as its period must recur in it")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
            runs = block_runs(*_numbered(texts), least, times)
            bounds = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
            left = [_collapsed(words, runs[a:b]).decode() for words, a, b in zip(texts, bounds, bounds[1:])]
            parts = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], fields=list(_RUN))
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), parts)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists, pa.array(left, pa.string())], ["doc_id", "runs", "collapsed"])

        for batch in batches:
            ids, texts, words = [], [], 0
            for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                found = (text.as_py() or "").encode().split()
                if texts and words + len(found) > BLOCK_WORDS:
                    yield done(ids, texts)
                    ids, texts, words = [], [], 0
                ids.append(doc.as_py())
                texts.append(found)
                words += len(found)
            if texts:
                yield done(ids, texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        rows, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` with repetitions laid over a tenth of its texts, as a digest of the doc_id says: (doc_id, text).

    h is crc32 of the decimal doc_id, g = h div 10. Where h mod 10 is 0 and the
    text has n > 0 words, word i >= a becomes word a + (i - a) mod p, with
    a = g mod n and p = 1 + (n - a) div (3 + g mod 8). A null doc_id has no digest
    and keeps its text.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), h.alias("h"))
    # The word list is made where the digest asks for it, and only there.
    chosen = F.when(F.col("h") % 10 == 0, words)
    g, n = F.floor(F.col("h") / 10), F.size("w")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    copies = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), copies))
    laid = F.array_join(F.slice(F.concat(F.slice("w", F.lit(1), F.col("a")), cycle), F.lit(1), n), " ")
    return (
        marked.withColumn("w", chosen)
        .withColumn("a", F.when(F.size("w") > 0, a)).withColumn("p", F.when(F.size("w") > 0, p))
        .select("doc_id", F.when(F.col("a").isNotNull(), laid).otherwise(F.col("text")).alias("text"))
    )
