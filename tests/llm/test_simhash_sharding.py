"""Fingerprints, links and components against plain Python; shards."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tallyshelf.llm import common, sharding, simhash

from .fixtures import awkward, docs, real


def plain_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(fps, max_bits=2):
    """Root position of each fingerprint by comparing all of them."""
    values, root = np.array(fps, np.uint64), list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= max_bits):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints_equal_plain_python():
    for _, text in awkward() + real():
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    assert simhash.fingerprint("A B c") == simhash.fingerprint("a\x0bb \x1c c".replace("\x1c ", "")) != 0
    # The last code point of U+001C is no white space here, unlike in str.split().
    assert simhash.fingerprint("a\x1cb") == plain_fingerprint("a\x1cb")


def as_long(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("max_bits", [0, 1, 2])
@pytest.mark.parametrize("crowded", [256, 3])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, max_bits, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = random.Random(max_bits)
    fps = {0, (1 << 64) - 1, 1 << 63, 1 | 1 << 63, 1 << 31 | 1 << 32}
    for _ in range(30):
        seed = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 9])):
            flips = rng.sample(range(64), rng.randint(0, 4))
            fps.add(seed ^ sum(1 << f for f in flips))
    # A dense cluster: far more than CROWDED in a bucket.
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << p) for p in range(64)}
    fps = sorted(fps)
    df = spark.createDataFrame([(as_long(f),) for f in fps], "fp long")
    found = simhash.links(df, max_bits)
    for r in found.collect():
        assert r.a != r.b and ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2 * max_bits * crowded
    roots = {r.node: r.root for r in common.components(found).collect()}
    want = smallest_reachable(fps, max_bits)
    groups, expected = defaultdict(set), defaultdict(set)
    for f, w in zip(fps, want):
        groups[roots.get(as_long(f), as_long(f))].add(f)
        expected[w].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_more_bits_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (7, 6)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 300)}}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates(spark):
    rows = awkward() + real()
    got = Counter((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(docs(spark, rows)).collect())
    fps = [plain_fingerprint(t) for _, t in rows]
    roots, least = smallest_reachable(fps), {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    assert got == Counter((i, f, least.get(r)) for (i, _), f, r in zip(rows, fps, roots))
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def check_shards(rows, found, shards):
    sizes = Counter(r.shard for r in found)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(shards)) <= 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    for s in sizes:
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sizes[s]))


def test_shards_keep_groups_together(spark):
    rows = [*awkward(), *real()]
    found = sharding.balanced_shards(docs(spark, rows), 16).collect()
    check_shards(rows, found, 16)
    held = defaultdict(set)
    for r in found:
        held[bytes(r.digest)].add(r.shard)
    assert all(len(s) == 1 for s in held.values())


def test_group_larger_than_a_shard_fills_whole_shards(spark):
    rows = [(i, "copy") for i in range(100)] + [(100 + i, f"text {i // 2}") for i in range(100)] + [(300 + i, f"own {i}") for i in range(100)]
    found = sharding.balanced_shards(docs(spark, rows), 10).collect()
    check_shards(rows, found, 10)
    copies = Counter(r.shard for r in found if r.doc_id < 100)
    # 30 rows fit a shard; a few more shards than the four needed at most.
    assert len(copies) <= 6
    pairs = defaultdict(set)
    for r in found:
        if 100 <= r.doc_id < 200:
            pairs[r.text_crc32].add(r.shard)
    assert sum(len(s) > 1 for s in pairs.values()) <= 5


def test_only_copies_and_few_rows(spark):
    for rows in ([(i, "same") for i in range(40)], [(1, "a")], [(1, None), (2, None), (None, "")], []):
        found = sharding.balanced_shards(docs(spark, rows), 16).collect()
        if rows:
            check_shards(rows, found, 16)
        assert len(found) == len(rows)


def test_quotas_hold():
    rng = random.Random(1)
    for _ in range(200):
        n = 5
        room = [rng.randint(0, 5) for _ in range(n)]
        wanted = {(a, b): rng.randint(0, 20) for a in range(n) for b in range(n) if a != b}
        allowed = sharding._quotas(wanted, room)
        net = [sum(v for (a, b), v in allowed.items() if b == s) - sum(v for (a, b), v in allowed.items() if a == s) for s in range(n)]
        assert all(0 <= allowed[k] <= wanted[k] for k in wanted) and all(x <= y for x, y in zip(net, room))
        moved = Counter()
        for a, first, last, b in sharding._refill(net):
            moved[a] -= last - first + 1
            moved[b] += last - first + 1
        assert all(net[s] + moved[s] == 0 for s in range(n))


def test_numbers_have_no_gaps(spark):
    rows = [(i % 3 if i % 2 else 0, i) for i in range(3000)]
    df = common.numbered(spark.createDataFrame(rows, "k int, v long"), ["k"], ["v"], "n", 3000)
    by = defaultdict(list)
    for r in df.collect():
        by[r.k].append(r.n)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
