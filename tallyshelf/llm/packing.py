"""Best-fit packing of token pieces into sequences."""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import numbered, stored

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """Every document's ids and an end id, in pieces of at most ``capacity``; only the first piece may be shorter."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = tokens.load(tokenizer).ids, end_id.to_bytes(4, "little")
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                data = encode(text.as_py() or "") + end
                total = len(data) // 4
                first = (total - 1) % capacity + 1
                bounds = [0, *range(first, total + 1, capacity)]
                for n, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    part = data[4 * a:4 * b]
                    row = (doc.as_py(), n, a, b - a, zlib.crc32(part), part if with_ids else None)
                    for column, value in zip(out, row):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            keep = len(names) if with_ids else len(names) - 1
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out[:keep], kinds)], names[:keep])

    schema = _PIECES + (", ids binary" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        pieces, schema
    )


def plan(sizes: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each size go, from their counts alone.

    Returns runs (length, first, last, per, sequence, offset): the pieces of
    that length numbered first..last fill sequences from ``sequence`` on, ``per``
    in each, the first at ``offset``. At most ``capacity`` sizes exist, so this
    is a few thousand runs whatever the number of pieces.

    Pieces above a third of the capacity fit at most twice: from the largest
    down each is matched with the largest one left that fits beside it. Smaller
    ones then go, from the largest down, to the fullest sequence with room.
    """
    left, runs, sequences = dict(sizes), [], 0
    used: dict[int, int] = defaultdict(int)
    open_at: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left: (first sequence, how many)
    rooms: list[int] = []

    def put(size: int, count: int, per: int, sequence: int, offset: int) -> None:
        runs.append((size, used[size], used[size] + count - 1, per, sequence, offset))
        used[size] += count
        left[size] -= count

    def leave(room: int, sequence: int, count: int) -> None:
        if room and count:
            if not open_at[room]:
                insort(rooms, room)
            open_at[room].append((sequence, count))

    large = sorted(s for s in sizes if 3 * s > capacity and sizes[s])
    while large:
        size = large[-1]
        at = bisect_right(large, capacity - size) - 1
        if at < 0:
            count = left[size]
            put(size, count, 1, sequences, 0)
            leave(capacity - size, sequences, count)
        elif large[at] == size:
            # Its largest partner is its own size: pairs, and one left over meets a smaller one next.
            count = left[size] // 2
            if count == 0:
                if at == 0:
                    put(size, 1, 1, sequences, 0)
                    leave(capacity - size, sequences, 1)
                    count = 1
                else:
                    other, count = large[at - 1], 1
                    put(size, 1, 1, sequences, 0)
                    put(other, 1, 1, sequences, size)
                    leave(capacity - size - other, sequences, 1)
                    if not left[other]:
                        large.remove(other)
            else:
                put(size, 2 * count, 2, sequences, 0)
                leave(capacity - 2 * size, sequences, count)
        else:
            other = large[at]
            count = min(left[size], left[other])
            put(size, count, 1, sequences, 0)
            put(other, count, 1, sequences, size)
            leave(capacity - size - other, sequences, count)
            if not left[other]:
                large.remove(other)
        sequences += count
        if not left[size]:
            large.remove(size)

    for size in sorted((s for s in sizes if 3 * s <= capacity and sizes[s]), reverse=True):
        while left[size]:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                per = capacity // size
                leave(capacity, sequences, -(-left[size] // per))
                sequences += -(-left[size] // per)
                continue
            room = rooms[at]
            first, count = open_at[room].pop()
            if not open_at[room]:
                rooms.pop(at)
            per = room // size
            whole = min(count, left[size] // per)
            if whole:
                put(size, whole * per, per, first, capacity - room)
                leave(room - per * size, first, whole)
                first, count = first + whole, count - whole
            if count and left[size]:
                some = left[size]
                put(size, some, some, first, capacity - room)
                leave(room - some * size, first, 1)
                first, count = first + 1, count - 1
            leave(room, first, count)
    return runs


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False,
) -> DataFrame:
    """Documents as pieces in as few sequences as matching and best fit find.

    (doc_id, piece, start, length, ids_crc32, sequence_id, offset), with the ids
    themselves (little-endian unsigned 32-bit) where asked. The pieces are
    written once, as encoding is dear; their counts by length, at most
    ``capacity`` rows, make the plan on the driver, which is exact for any
    number of pieces. Pieces are then numbered within their length and find
    their place by one join with the plan's runs, so no task or group holds
    more than its share, however many pieces are alike.

    A null text is the empty text: the end id alone. Null and repeated doc_ids
    and repeated rows are packed like any other. Other columns are ignored. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = stored(cut(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    sizes = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    runs = plan(sizes, capacity)
    table = spark.createDataFrame(
        runs or [(0, 0, -1, 1, 0, 0)], "run_length long, first long, last long, per long, sequence long, at long"
    )
    order = ["doc_id", "piece", "start", "ids_crc32"]
    ranked = numbered(pieces, ["length"], order, "rank", sum(sizes.values()))
    placed = ranked.join(
        F.broadcast(table), (F.col("length") == F.col("run_length")) & F.col("rank").between(F.col("first"), F.col("last"))
    )
    nth = F.col("rank") - F.col("first")
    return placed.select(
        *pieces.columns,
        (F.col("sequence") + F.floor(nth / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(nth, F.col("per")) * F.col("length")).cast("long").alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: (sequence_id, ids), from a result with ids. A group holds at most the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
