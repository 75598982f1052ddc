"""Token ids against the library, counts with a cache, and packing."""

from __future__ import annotations

import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyshelf.llm import packing, token_counts, tokens

from .fixtures import awkward, docs, real

FILE = tokens.public_file("byte_bpe_50k.json")


def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


LIBRARY = library()


def plain(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def quick(text):
    return np.frombuffer(tokens.load(FILE).ids(text), "<u4").tolist()


def test_plain_byte_level_file_is_recognised():
    assert isinstance(tokens.load(FILE), tokens.ByteLevelIds)
    assert isinstance(tokens.load(tokens.public_file("word_bpe_49k.json")), tokens.LibraryIds)
    assert isinstance(tokens.load(tokens.public_file("piece_bpe_32k.model")), tokens.LibraryIds)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(list(" \n\t\r  \u0085\x1cab'sTé文½Ⅷ9_-.!😀́ſ")) | st.characters(codec="utf-8"), max_size=60))
def test_ids_equal_the_library(text):
    assert quick(text) == plain(text)


@pytest.mark.parametrize("text", [
    "a<|endoftext|>b", "a <|endoftext|> b", "<|endoftext|><|endoftext|>", " <|endoftext|", "a  <|endoftext|>  b", "we'll don't I'M 's",
    "x" * 3000, "1234567890 " * 50, " lead", "trail ", "\n\n", "a \n b",
])
def test_special_strings_and_edges(text):
    assert quick(text) == plain(text)


def test_counts(spark):
    rows = awkward() + real()
    df = docs(spark, rows)
    cache = token_counts.new_cache(df)
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(df, cache, FILE).collect())
    want = Counter()
    for i, t in rows:
        n = len(plain(t))
        want[i, len((t or "").encode()), n, n > 1024] += 1
    assert got == want


def test_cache_is_used_and_extended(spark):
    df = docs(spark, [(1, "red green"), (2, "red green"), (3, None)])
    cache = token_counts.new_cache(df)
    token_counts.count_tokens(df, cache, FILE)
    assert spark.read.parquet(cache).count() == 2
    token_counts.count_tokens(df, cache, FILE)
    assert spark.read.parquet(cache).count() == 2
    # A stored count is believed: change one and see it come back.
    other = token_counts.new_cache(df)
    spark.read.parquet(cache).selectExpr("digest", "n_tokens + 100 AS n_tokens", "tokenizer").write.parquet(other)
    more = docs(spark, [(1, "red green"), (4, "blue")])
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(more, other, FILE).collect()}
    assert got == {1: len(plain("red green")) + 100, 4: len(plain("blue"))}
    # Another tokenizer version shares nothing.
    word = tokens.public_file("word_bpe_49k.json")
    again = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(more, other, word).collect()}
    assert again[1] == 2 and spark.read.parquet(other).groupBy("tokenizer").count().count() == 2
    # A digest appended twice counts once.
    spark.read.parquet(other).write.mode("append").parquet(other + "-twice")
    spark.read.parquet(other).write.mode("append").parquet(other + "-twice")
    assert token_counts.count_tokens(more, other + "-twice", FILE).count() == 2


def test_empty_table_counts(spark):
    df = docs(spark, [])
    assert token_counts.count_tokens(df, token_counts.new_cache(df), FILE).count() == 0


def check_packed(rows, packed, capacity):
    """Pieces are right, places are gapless; returns the number of sequences."""
    want = Counter()
    for i, text in rows:
        ids = [*plain(text), 0]
        first = (len(ids) - 1) % capacity + 1
        bounds = [0, *range(first, len(ids) + 1, capacity)]
        for n, (a, b) in enumerate(zip(bounds, bounds[1:])):
            want[i, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    filled = defaultdict(list)
    for r in packed:
        filled[r.sequence_id].append((r.offset, r.length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(filled)


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing(spark, capacity):
    rows = awkward() + real()
    packed = packing.pack(docs(spark, rows), FILE, capacity, 0, with_ids=True)
    found = packed.collect()
    count = check_packed(rows, found, capacity)
    assert count <= 1.02 * sum(r.length for r in found) / capacity + 1
    whole = packing.sequences(packed).collect()
    ids = {r.sequence_id: bytes(r.ids) for r in whole}
    for r in found:
        assert ids[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)


def test_packing_nothing(spark):
    assert packing.pack(docs(spark, []), FILE).count() == 0


def fewest(sizes, capacity):
    """Least number of bins, by trying."""
    best = len(sizes)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(sizes):
            best = len(bins)
            return
        for i in {b: i for i, b in enumerate(bins)}.values():
            if bins[i] >= sizes[k]:
                place(k + 1, bins[:i] + [bins[i] - sizes[k]] + bins[i + 1:])
        place(k + 1, bins + [capacity - sizes[k]])

    place(0, [])
    return best


def test_plan_is_complete_and_close_to_the_least():
    rng = random.Random(5)
    for _ in range(300):
        capacity = rng.choice([9, 10, 30])
        sizes = sorted((rng.randint(1, capacity) for _ in range(rng.randint(0, 9))), reverse=True)
        counts, bins, placed = Counter(sizes), defaultdict(list), Counter()
        for size, first, last, per, sequence, at in packing.plan(counts, capacity):
            for k in range(last - first + 1):
                bins[sequence + k // per].append((at + k % per * size, size))
            placed[size] += last - first + 1
        assert placed == counts
        for places in bins.values():
            end = 0
            for at, size in sorted(places):
                assert at == end
                end += size
            assert end <= capacity
        least = fewest(sizes, capacity)
        assert len(bins) <= least + (0 if all(3 * s > capacity for s in sizes) else 1)


def test_plan_handles_any_number_of_pieces():
    runs = packing.plan({2048: 10**12, 700: 10**12, 600: 10**11, 3: 10**12}, 2048)
    assert len(runs) < 50
