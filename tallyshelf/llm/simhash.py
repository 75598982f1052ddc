"""SimHash near-duplicates: deletion-variant signatures for few bits, samples of bits for groups of candidates."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, members, stored

SEED = 42
BITS = 64
# Buckets up to this size are compared member by member, larger ones by second wildcards.
CROWDED = 256
# Bucket keys that may be broadcast: 8 bytes each.
BROADCAST_KEYS = 1_000_000
_BLOCK = 1 << 16
# Members of a bucket that meet as many others in a task.
CHUNK = 4096
# For links of many bits: so many samples of so many of the 64 bits; fingerprints that agree on a sample meet.
SAMPLES, SAMPLE_BITS = 32, 20


def _lanes() -> np.ndarray:
    """For each byte, its eight bits in the eight bytes of one number, to add up to 255 of them at once."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view("<u8").ravel()


_LANES = _lanes()


def fingerprint(text: str | None, words: int = 3) -> int:
    """A bit is 1 where it is set in over half of the hashes of the word shingles, repeats included.

    A-Z count as lower case; words are cut at ASCII white space. Fewer words
    than a shingle are one shingle; none gives zero.
    """
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    joined, width = b" ".join(found), min(words, len(found))
    sizes = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends - sizes + 1)[: len(found) - width + 1].tolist()
    ends = ends[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    parts = (
        np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + _BLOCK], ends[at:at + _BLOCK])], "<u8")
        for at in range(0, len(starts), _BLOCK))
    return _majority(parts, len(starts))


def _majority(parts: Iterable[np.ndarray], total: int) -> int:
    """The bits that are set in over half of ``total`` hashes, which come in parts."""
    ones = np.zeros(BITS, np.int64)
    for part in parts:
        rows = part.view(np.uint8).reshape(-1, 8)
        sums = np.add.reduceat(_LANES[rows], np.arange(0, len(part), 255), axis=0)
        ones += sums.view(np.uint8).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint's 64 bits as a long."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), words) for t in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id long, fp long")


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, bits) of the fewest segments of which one differs by at most one bit."""
    count = max_bits // 2 + 1
    bounds = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def _without(value: Column, bit: int) -> Column:
    """``value`` with one bit taken out."""
    high = F.shiftleft(F.shiftrightunsigned(value, bit + 1), bit) if bit < BITS - 1 else F.lit(0).cast("long")
    return high.bitwiseOR(value.bitwiseAND(F.lit((1 << bit) - 1).cast("long")))


def _variants(fps: DataFrame, max_bits: int) -> DataFrame:
    """A row for each segment and wildcard: the segment without that bit, tagged with its place."""
    keys = []
    for low, size in _segments(max_bits):
        part = F.shiftrightunsigned("fp", low)
        if size < BITS:
            part = part.bitwiseAND(F.lit((1 << size) - 1).cast("long"))
        for bit in range(size):
            rest = _without(part, bit)
            # A segment of 32 bits leaves room for its tag; a longer one is mixed, and links are verified anyway.
            key = rest * BITS + (low + bit) if size <= 32 else F.xxhash64(rest, F.lit(low + bit))
            keys.append(key)
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def _differ(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _links_in_lists(lists: DataFrame, max_bits: int) -> DataFrame:
    """For each bucket's list, every member with the smallest one of those it reaches inside the bucket."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for members in batch.column("fps"):
                fps = np.unique(np.array(members.as_py(), np.int64))
                near = np.bitwise_count((fps[:, None] ^ fps[None, :]).view(np.uint64)) <= max_bits
                root = np.arange(len(fps))
                while True:
                    least = np.where(near, root[None, :], len(fps)).min(axis=1)
                    if (least == root).all():
                        break
                    root = least
                moved = root != np.arange(len(fps))
                a.append(fps[moved])
                b.append(fps[root[moved]])
            both = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in both], ["a", "b"])

    return lists.select("fps").mapInArrow(rows, "a long, b long")


def _links_by_second_wildcard(members: DataFrame, max_bits: int) -> DataFrame:
    """Links inside crowded buckets without comparing members: equal but for ``max_bits`` named bits.

    At most ``2 ** max_bits`` fingerprints agree on all other bits, so no group
    is large, and all of a group are linked.
    """
    places = [(p, q) for p in range(BITS) for q in range(p + 1, BITS)] if max_bits == 2 else [(p, p) for p in range(BITS)]
    masks = F.array(*[F.lit(((1 << p) | (1 << q)) - (1 << 64 if q == 63 else 0)).cast("long") for p, q in places])
    spread = members.select("fp", F.explode(masks).alias("mask"))
    spread = spread.withColumn("rest", F.col("fp").bitwiseAND(F.bitwise_not("mask")))
    groups = spread.groupBy("mask", "rest").agg(F.min("fp").alias("b"), F.collect_set("fp").alias("fps"))
    return groups.filter(F.size("fps") > 1).select(F.explode("fps").alias("a"), "b").filter("a <> b")


def _links_in_buckets(keyed: DataFrame, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """Links inside the buckets of up to ``CROWDED`` members of (key, fp), and the members (key, fp, n) of larger ones."""
    buckets = stored(
        keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .filter("n > 1"), "buckets",
    )
    pairs = buckets.filter("n = 2").select("a", "b").filter(_differ(F.col("a"), F.col("b")) <= max_bits)
    crowded = buckets.filter("n > 2").select("key", "n")
    if crowded.count() <= BROADCAST_KEYS:
        crowded = F.broadcast(crowded)
    members = keyed.join(crowded, "key")
    lists = members.filter(F.col("n") <= CROWDED).groupBy("key").agg(F.collect_list("fp").alias("fps"))
    return pairs.unionByName(_links_in_lists(lists, max_bits)), members.filter(F.col("n") > CROWDED).select("key", "fp", "n")


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect the same ones as all pairs within ``max_bits``.

    Fingerprints are cut into the fewest segments of which one must differ by at
    most one bit; each segment is indexed once for every bit left out, and equal
    keys meet. Keys are counted first: two members are compared at once, up to
    ``CROWDED`` inside their bucket, and members of larger buckets meet again
    under second wildcards, so all pairs of a group are never made.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("links take at most 2 differing bits: larger buckets are split by naming all differing bits")
    # A row becomes dozens: few tasks that read many fingerprints would each make very many keys.
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = _variants(fps.repartition(tasks, "fp"), max_bits)
    found, crowded = _links_in_buckets(keyed, max_bits)
    if max_bits:
        most = crowded.select("fp").distinct()
        found = found.unionByName(_links_by_second_wildcard(most, max_bits))
    return found.distinct()


def near_duplicates(docs: DataFrame, max_bits: int = 2, words: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id reachable over fingerprints at most ``max_bits`` apart.

    Equal fingerprints are one node. Null and empty texts have fingerprint zero
    and are linked like any other; a null doc_id keeps its row and counts for
    no smallest id (null where there is no other). Repeated rows each keep
    their row. Other columns are ignored; an empty table gives no rows.
    """
    marked = stored(fingerprints(docs, words), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(links(nodes.select("fp"), max_bits))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    classes = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    found = rooted.join(classes, "root").select("fp", "component_id")
    return marked.join(found, "fp").select("doc_id", "fp", "component_id")


# --- links of many bits ------------------------------------------------------------------


def _places() -> list[np.ndarray]:
    """The bits of each sample, the same in every task."""
    rng = np.random.default_rng(SEED)
    return [np.sort(rng.choice(BITS, SAMPLE_BITS, replace=False)).astype(np.uint64) for _ in range(SAMPLES)]


def of_set(hashes: np.ndarray) -> int:
    """The fingerprint of a set of 64-bit shingle hashes, as a long."""
    fp = _majority((hashes[at:at + _BLOCK] for at in range(0, len(hashes), _BLOCK)), len(hashes))
    return fp - (1 << BITS) if fp >> (BITS - 1) else fp


def set_fingerprints(sets: DataFrame) -> DataFrame:
    """(node, fp): the fingerprint of each set of 64-bit shingle hashes (columns node, hashes)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [of_set(np.frombuffer(hashes.as_py(), "<u8")) for hashes in batch.column("hashes")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(fps, pa.int64())], ["node", "fp"])

    return sets.select("node", "hashes").mapInArrow(rows, "node long, fp long")


def _sampled(fps: DataFrame) -> DataFrame:
    """(key, fp): a row for each sample, its bits tagged with its number."""
    places = _places()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for n, place in enumerate(places):
                key = np.full(len(fp), n, np.uint64)
                for bit in place:
                    key = (key << np.uint64(1)) | ((fp >> bit) & np.uint64(1))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))], ["key", "fp"])

    return fps.mapInArrow(rows, "key long, fp long")


def _links_between(crowded: DataFrame, found: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) between the chunks of crowded buckets (key, fp, n), such that with ``found`` all pairs of a bucket are connected as they should be.

    Pairs inside a group that is connected already need no look, so members of
    a bucket's largest group meet only those outside it. Chunk meets chunk, each
    pair of chunks in a task of its own.
    """
    spark = crowded.sparkSession
    near = components(found)
    roots = stored(near.unionByName(near.select(F.col("root").alias("node"), "root").distinct()), "roots")
    labelled = crowded.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("key", "fp", "n", F.coalesce("root", "fp").alias("label"))
    sizes = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("key").agg(F.max_by("label", F.struct("size", "label")).alias("largest"), F.count(F.lit(1)).alias("labels"))
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    left = stored(labelled.join(largest.filter("labels > 1").drop("labels"), "key").select(
        "key", "fp", (F.col("label") != F.col("largest")).alias("active"), chunks.alias("chunks"),
        F.pmod(F.xxhash64("fp"), chunks).cast("int").alias("chunk")), "open")
    if left.isEmpty():
        return spark.createDataFrame([], "a long, b long")
    each = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))

    def linked(one: pa.Table, two: pa.Table) -> pa.Table:
        mine, others = one.column("fp").to_numpy(), two.column("fp").to_numpy()
        a, b, root = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.arange(len(others))
        for fp in mine:
            # A link to one of each group met, which is one group from then on: no more links than members.
            tops = np.unique(root[np.bitwise_count((others ^ fp).view(np.uint64)) <= max_bits])
            a.append(np.full(len(tops), fp))
            b.append(others[tops])
            if len(tops) > 1:
                root[np.isin(root, tops)] = tops[0]
        return pa.table({"a": pa.array(np.concatenate(a)), "b": pa.array(np.concatenate(b))})

    columns = ["key", "chunk", "other", "fp"]
    one = left.filter("active").withColumn("other", each).select(*[F.col(c).alias(c) for c in columns])
    two = left.withColumn("other", F.col("chunk")).withColumn("chunk", each).select(*[F.col(c).alias(c) for c in columns])
    keys = columns[:3]
    return one.groupBy(*keys).cogroup(two.groupBy(*keys)).applyInArrow(linked, "a long, b long").filter("a <> b").distinct()


def links_by_samples(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links (a, b) that connect the same distinct fingerprints (column fp) as all pairs within ``max_bits`` that agree on a sample."""
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found, crowded = _links_in_buckets(_sampled(fps.repartition(tasks, "fp")), max_bits)
    chunk = F.pmod(F.xxhash64("fp", F.lit(SEED)), F.ceil(F.col("n") / CROWDED))
    crowded = stored(crowded, "crowded")
    lists = crowded.groupBy("key", chunk.alias("chunk")).agg(F.collect_list("fp").alias("fps"))
    found = stored(found.unionByName(_links_in_lists(lists, max_bits)).distinct(), "near")
    return found if crowded.isEmpty() else found.unionByName(stored(_links_between(crowded, found, max_bits), "near"))


def groups(sets: DataFrame, max_bits: int) -> DataFrame:
    """(region, node): sets (columns node, hashes or fp) that hang together by fingerprints at most ``max_bits`` apart.

    Fingerprints that agree on all bits of a sample meet, so groups are
    candidates: two sets at such a distance may share no sample, and what a
    group holds is still to be verified. Whatever meets is compared, however
    many meet.
    """
    fps = stored(sets.select("node", "fp") if "fp" in sets.columns else set_fingerprints(sets), "set_fingerprints")
    heads = stored(fps.groupBy("fp").agg(F.min("node").alias("head")), "heads")
    near = links_by_samples(heads.select("fp"), max_bits)
    a, b = heads.select(F.col("fp").alias("a"), F.col("head").alias("u")), heads.select(F.col("fp").alias("b"), F.col("head").alias("v"))
    found = near.join(a, "a").join(b, "b").select(F.col("u").alias("a"), F.col("v").alias("b"))
    same = fps.join(heads, "fp").filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    return members(components(stored(found.unionByName(same), "near")))
