"""Repeated passages: units are hashed, all but the earliest occurrence go, with their offsets."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh

# What stands between units.
_BREAKS = {
    "sentence": re.compile(r"(?<=[.!?])\s+|\n"),
    "line": re.compile(r"\n"),
    "paragraph": re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+"),
}
_UNIT = "doc_id long, row long, k int, start int, end int, first_word int, last_word int, digest binary, first boolean"
_KINDS = [pa.int64(), pa.int64(), *[pa.int32()] * 5, pa.binary(), pa.bool_()]
_NAMES = [c.split(" ")[0] for c in _UNIT.split(", ")]


def units_of(text: str, unit: str = "sentence", min_words: int = 4) -> list[tuple]:
    """(k, start, end, first_word, last_word, digest, first in this text) of every unit with enough words.

    A unit's normal form is its words in lower case, one space between them.
    ``k`` numbers the units returned; offsets are code points from the first to
    behind the last word, which are counted over the whole text.
    """
    found, seen, at, count = [], set(), 0, 0
    digest = xxhash.xxh3_128_digest
    for gap in [*(m.span() for m in _BREAKS[unit].finditer(text)), (len(text), len(text))]:
        part = text[at:gap[0]]
        words = part.lower().split()
        if len(words) >= min_words:
            name = digest(" ".join(words).encode())
            start = at + len(part) - len(part.lstrip())
            found.append((len(found), start, start + len(part.strip()), count, count + len(words), name, name not in seen))
            seen.add(name)
        count += len(words)
        at = gap[1]
    return found


def units(docs: DataFrame, unit: str = "sentence", min_words: int = 4) -> DataFrame:
    """The units of all texts; ``row`` is a hash of the text, which tells documents of one doc_id apart."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in _NAMES]
            for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                text = text.as_py() or ""
                found = units_of(text, unit, min_words)
                if found:
                    row = xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)
                    out[0] += [doc.as_py()] * len(found)
                    out[1] += [row] * len(found)
                    for column, values in zip(out[2:], zip(*found)):
                        column += values
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, _KINDS)], _NAMES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, _UNIT)


def repeated_passages(docs: DataFrame, unit: str = "sentence", min_words: int = 4, min_run: int = 25) -> DataFrame:
    """Passages to remove: (doc_id, start, end, words, kept_doc_id).

    Of equal units the one in the smallest doc_id stays, the earliest there; all
    others are repeats. Repeats in a row make a passage, which is removed if it
    has ``min_run`` words or more: single short formulas recur in unrelated
    documents. Units of fewer than ``min_words`` words are not compared and go
    with the passage around them. ``kept_doc_id`` is the smallest document that
    keeps one of the passage's units.

    Digests are counted map-side first; only digests that occur again meet their
    units, and a digest in very many documents is split by the join, as nothing
    gathers its units. What is gathered by document are its own repeats.

    A null or empty text has no units. Null doc_ids rank last. Rows that share
    doc_id and text are one document; other rows of a doc_id rank alike, so each
    keeps its first unit. Other columns are ignored; an empty table gives no rows.
    """
    found = units(docs, unit, min_words)
    repeated = found.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("kept_doc_id")
    ).filter("n > 1").drop("n")
    again = found.join(repeated, "digest").filter(~(F.col("first") & F.col("doc_id").eqNullSafe(F.col("kept_doc_id"))))
    # Repeated rows share their ranks, so numbers less ranks still tell the runs apart.
    rank = F.dense_rank().over(Window.partitionBy("doc_id", "row").orderBy("k"))
    runs = again.withColumn("run", F.col("k") - rank).groupBy("doc_id", "row", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        (F.max("last_word") - F.min("first_word")).alias("words"), F.min("kept_doc_id").alias("kept_doc_id"),
    )
    return runs.filter(F.col("words") >= min_run).select("doc_id", "start", "end", "words", "kept_doc_id")


def without_passages(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` with the removed passages cut out of their texts and ``cuts``, the original (start, end) of each.

    ``cuts`` gets underscores where ``docs`` has such a column.

    A line break behind a passage goes with it. Documents without cuts stay as
    they are, with ``cuts`` null; so do those with a null doc_id.
    """
    cuts = fresh(docs, "cuts")
    spans = removed.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias(cuts))

    @F.arrow_udf("string")
    def cut(texts: pa.Array, cuts: pa.Array) -> pa.Array:
        out = []
        for text, spans in zip(texts.to_pylist(), cuts.to_pylist()):
            if text is not None and spans:
                parts, at = [], 0
                for s in spans:
                    parts.append(text[at:s["start"]])
                    at = s["end"] + (text[s["end"]:s["end"] + 1] == "\n")
                text = "".join([*parts, text[at:]])
            out.append(text)
        return pa.array(out, pa.string())

    joined = docs.join(spans, "doc_id", "left")
    return joined.withColumn("text", cut("text", cuts)).select(*docs.columns, cuts)
