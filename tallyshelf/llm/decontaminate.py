"""Benchmark decontamination: rare n-gram seeds, then local alignment."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, lean, stored, text_key

GRAM = 3
# A filter of 2 ** FILTER_BITS bits (1 MiB) is all that is broadcast, whatever the benchmark's size.
FILTER_BITS = 23
MEMO_ENTRIES = 100_000
# Fixed value: letters of scripts that are written without spaces; each is a word.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_LETTER = re.compile(f"[{_UNSPACED}]")
_WORD = re.compile(r"\w+")
_MIXED = re.compile(f"[{_UNSPACED}]|[^\\W{_UNSPACED}]+")
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _Hashes(dict):
    """Word hashes, remembered for as many words as fit."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word.encode())
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        self[word] = value
        return value


_HASH = _Hashes()


def words_of(text: str | None) -> list[str]:
    text = (text or "").lower()
    # Without such letters both patterns cut alike, and the plain one is the quicker.
    plain = text.isascii() or not _LETTER.search(text)
    return (_WORD if plain else _MIXED).findall(text)


def _grams(words: list[str], size: int = GRAM) -> np.ndarray:
    """A hash for every ``size`` words in a row; one for all of fewer words, which equals that of the same few words only."""
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest("\n".join(words).encode(), len(words))] if words else [], np.uint64)
    ids = np.fromiter(map(_HASH.__getitem__, words), np.uint64, len(words))
    n = len(ids) - size + 1
    sums = ids[:n] * _ODD[0]
    for k in range(1, size):
        sums = (sums ^ (sums >> np.uint64(29))) * _ODD[k] + ids[k:n + k]
    return (sums ^ (sums >> np.uint64(32))) * _ODD[0]


def _place(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _filter(grams: DataFrame) -> np.ndarray:
    """One bit for each gram (column gram) that may occur: rows of 64 bits are or-ed by Spark, at most 128 Ki of them."""
    place = F.shiftrightunsigned("gram", 64 - FILTER_BITS)
    cells = grams.select(F.shiftright(place, 6).alias("cell"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    rows = cells.groupBy("cell").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).collect()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for r in rows:
        bits[r["cell"]] = r["bits"]
    return np.unpackbits(bits.view(np.uint8), bitorder="little")


def _packed(bits: np.ndarray) -> bytes:
    return np.packbits(bits, bitorder="little").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little").view(bool)


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, pos, gram): every gram of the items."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for item, text in zip(batch.column("item_id"), batch.column("text")):
                grams = _grams(words_of(text.as_py()))
                out[0] += [item.as_py()] * len(grams)
                out[1] += range(len(grams))
                out[2] += grams.view(np.int64).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["item_id", "pos", "gram"])

    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        rows, "item_id long, pos long, gram long"
    )


def _frequencies(docs: DataFrame, data: bytes) -> DataFrame:
    """(gram, df): documents that hold each gram that passes the filter."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _unpacked(data)
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for text in batch.column("text"):
                grams = _grams(words_of(text.as_py()))
                hits = grams[wanted[_place(grams)]]
                if len(hits):
                    found.append(np.unique(hits))
            grams, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n)], ["gram", "n"])

    counts = docs.select("text").mapInArrow(rows, "gram long, n long")
    return counts.groupBy("gram").agg(F.sum("n").alias("df"))


def seeds(grams: DataFrame, frequencies: DataFrame, rare_docs: int, span: int) -> DataFrame:
    """(gram, item_id): each item's grams in at most ``rare_docs`` documents, and the rarest of any ``span`` in a row.

    Grams that no document holds are left out first, so every stretch of an item
    that occurs somewhere keeps a seed, common as its words may be.
    """
    present = grams.join(frequencies, "gram")
    row = Window.partitionBy("item_id").orderBy("pos")
    n = F.count(F.lit(1)).over(Window.partitionBy("item_id"))
    marked = present.select(
        "item_id", "gram", "df", F.row_number().over(row).alias("k"), n.alias("n"),
        F.min(F.struct("df", "gram")).over(row.rowsBetween(0, span - 1)).alias("least"),
    )
    windows = marked.filter((F.col("k") == 1) | (F.col("k") <= F.col("n") - span + 1))
    return marked.filter(F.col("df") <= rare_docs).select("gram", "item_id").unionByName(
        windows.select(F.col("least.gram").alias("gram"), "item_id")
    ).distinct()


def _passages(docs: DataFrame, data: bytes, reach: int) -> DataFrame:
    """(doc_id, text_key, first, words, digest, grams): stretches around seeds, ``reach`` words further on both sides."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _unpacked(data)
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64())]
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc, key, text in zip(batch.column("doc_id"), batch.column("text_key"), batch.column("text")):
                words = words_of(text.as_py())
                grams = _grams(words)
                hits = np.flatnonzero(wanted[_place(grams)])
                if not len(hits):
                    continue
                for part in np.split(hits, np.flatnonzero(np.diff(hits) > 2 * reach) + 1):
                    first, last = max(0, int(part[0]) - reach), int(part[-1]) + GRAM + reach
                    joined = " ".join(words[first:last])
                    row = (doc.as_py(), key.as_py(), first, joined, hashlib.md5(joined.encode()).digest(), np.unique(grams[part]).view(np.int64))
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)], ["doc_id", "text_key", "first", "words", "digest", "grams"]
            )

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(text).alias("text_key"), text.alias("text")).mapInArrow(
        rows, "doc_id long, text_key binary, first long, words string, digest binary, grams array<long>"
    )


def align(passage: list[str], item: list[str], match: int = 2, mismatch: int = -1, gap: int = -1) -> tuple[int, int]:
    """Smith-Waterman over words: the best local score and the passage position (past the end) where it ends.

    Row by row of the item; gaps along the passage are a running maximum.
    """
    numbers: dict[str, int] = {}
    a = np.array([numbers.setdefault(w, len(numbers)) for w in passage], np.int64)
    n, best, end = len(a), 0, 0
    slope = -gap * np.arange(n + 1)
    above = np.zeros(n + 1, np.int64)
    for word in item:
        row = np.zeros(n + 1, np.int64)
        step = np.where(a == numbers.get(word, -1), match, mismatch)
        row[1:] = np.maximum(0, np.maximum(above[:-1] + step, above[1:] + gap))
        row = np.maximum.accumulate(row + slope) - slope
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
        above = row
    return best, end


def _aligned(pairs: DataFrame) -> DataFrame:
    """(digest, item_id, similarity, end_word) for rows of passage and item words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, ends = [], []
            for passage, text in zip(batch.column("words"), batch.column("text")):
                item = words_of(text.as_py())
                best, end = align(passage.as_py().split(" "), item)
                scores.append(best / (2 * len(item)))
                ends.append(end)
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), batch.column("item_id"), pa.array(scores, pa.float64()), pa.array(ends, pa.int64())],
                ["digest", "item_id", "similarity", "end_word"],
            )

    return pairs.select("digest", "item_id", "words", "text").mapInArrow(
        rows, "digest binary, item_id long, similarity double, end_word long"
    )


def _hits(docs: DataFrame, benchmark: DataFrame, threshold: float, rare_docs: int, span: int) -> DataFrame:
    """(doc_id, text_key, item_id, similarity, end_word) of every stretch that holds an item."""
    lean(docs.sparkSession)
    grams = stored(items_of(benchmark), "grams")
    # Words of the longest item, as it was cut.
    reach = (grams.agg(F.max("pos")).first()[0] or 0) + GRAM
    frequencies = _frequencies(docs, _packed(_filter(grams)))
    chosen = stored(seeds(grams, frequencies, rare_docs, span), "seeds")
    passages = stored(_passages(docs, _packed(_filter(chosen)), reach), "passages")
    # One copy of each stretch, however many documents share it.
    distinct = passages.groupBy("digest").agg(F.first("words").alias("words"), F.first("grams").alias("grams"))
    pairs = distinct.select("digest", F.explode("grams").alias("gram")).join(chosen, "gram").select("digest", "item_id").distinct()
    text = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    scored = _aligned(pairs.join(distinct.select("digest", "words"), "digest").join(text, "item_id"))
    hits = stored(scored.filter(F.col("similarity") >= threshold), "aligned")
    return passages.select("doc_id", "text_key", "first", "digest").join(hits, "digest").select(
        "doc_id", "text_key", "item_id", "similarity", (F.col("first") + F.col("end_word")).alias("end_word"))


def leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, rare_docs: int = 50, span: int = 4,
) -> DataFrame:
    """Documents that hold a test item, whole or edited: (doc_id, item_id, similarity, end_word).

    Words are ``\\w+`` in lower case, single letters in scripts without spaces. Item grams are counted over all documents;
    an item's rare grams, and the rarest of every few in a row, are its seeds.
    Stretches of documents around seeds meet items by equality of a seed, equal
    stretches once, and are aligned word by word (+2 match, -1 substitution or
    gap). Similarity is the best local score over that of the whole item; rows
    reach ``threshold``. ``end_word`` counts the document's words up to the
    alignment's end.

    What tasks are sent is a filter of fixed size; grams that pass it by chance
    find no item. No stretch, pair or document is left out.

    Null and empty texts hold nothing, on either side. Items of one or two words
    are found where they are a document's whole text: inside longer ones such
    words say nothing. Repeated items of one id count by the
    best. A null doc_id keeps its row; repeated rows of a doc_id give one row
    for each item. Other columns are ignored; empty tables give no rows.
    """
    return _hits(docs, benchmark, threshold, rare_docs, span).groupBy("doc_id", "item_id").agg(
        F.max("similarity").alias("similarity"), F.min("end_word").alias("end_word"))


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, rare_docs: int = 50, span: int = 4,
) -> DataFrame:
    """``docs`` but for the rows whose text holds a test item, as ``leaks`` finds them.

    Rows go by doc_id and text together, so a null doc_id hides no leak, and of
    rows that share a doc_id only those that hold an item go.
    """
    doc, key = fresh(docs, "leak_doc"), fresh(docs, "leak_key")
    found = _hits(docs, benchmark, threshold, rare_docs, span).select(F.col("doc_id").alias(doc), F.col("text_key").alias(key)).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & text_key(F.col("text").cast("string")).eqNullSafe(F.col(key))
    return docs.join(found, same, "left_anti")
