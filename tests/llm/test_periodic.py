"""Periodic runs against their definition, tried word by word."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tallyshelf.llm import periodic, queries

from .fixtures import awkward, docs, real


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_runs(words, least=6, times=4):
    """All (start, length, period): smallest period, long enough, not to be extended."""
    n, found = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, times * q) and not any(
                all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)
            ):
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_planted(doc, words):
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def plain_collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def plain_row(doc, text):
    words = plain_planted(doc, plain_words(text))
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(plain_collapsed(words, runs)),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def of(words):
    return [tuple(r) for r in periodic.block_runs(np.array(words, np.int64), np.array([len(words)]))[:, 1:].tolist()]


@pytest.mark.parametrize("letters, trials", [(1, 30), (2, 700), (3, 300), (9, 60)])
def test_random_words(letters, trials):
    rng = random.Random(letters)
    for _ in range(trials):
        words = [rng.randrange(letters) for _ in range(rng.randrange(70))]
        if rng.random() < 0.7:
            part = [rng.randrange(letters) for _ in range(rng.randrange(1, 12))]
            at = rng.randrange(len(words) + 1)
            words[at:at] = (part * rng.randrange(2, 9))[: rng.randrange(200)]
        assert of(words) == plain_runs(words)


def test_texts_in_a_block_don_t_meet():
    rng = random.Random(3)
    texts = [[rng.randrange(2) for _ in range(rng.randrange(40))] for _ in range(200)] + [[], [0] * 9, [], [0] * 5]
    rows = periodic.block_runs(np.array(sum(texts, []), np.int64), np.cumsum([len(t) for t in texts]))
    for n, words in enumerate(texts):
        assert [tuple(r[1:]) for r in rows.tolist() if r[0] == n] == plain_runs(words)


def test_other_limits():
    rng = random.Random(4)
    for _ in range(200):
        words = [rng.randrange(2) for _ in range(60)]
        got = periodic.block_runs(np.array(words, np.int64), np.array([60]), 4, 3)[:, 1:].tolist()
        assert [tuple(r) for r in got] == plain_runs(words, 4, 3)


def test_long_text_of_one_word():
    assert of([7] * 300_000) == [(0, 300_000, 1)]


def test_query(spark, tmp_path, monkeypatch):
    rows = [(i, t) for i, t in awkward() if t is None or len(t) < 20_000] + [(i, t) for i, t in real() if len(t) < 6_000]
    rows += [(i, " ".join(f"w{k}" for k in range(i % 40))) for i in range(1000, 1400)]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path)).select(COLUMNS).collect()
    assert Counter(map(tuple, got)) == Counter(plain_row(i, t) for i, t in rows)
    assert sum(r.n_runs > 0 for r in got) > 30
    monkeypatch.setattr(periodic, "BLOCK_WORDS", 50)
    small = periodic.periodic_runs(docs(spark, rows)).collect()
    assert Counter((r.doc_id, r.collapsed, len(r.runs)) for r in small) == Counter(
        (i, plain_collapsed(plain_words(t), plain_runs(plain_words(t))), len(plain_runs(plain_words(t)))) for i, t in rows)


def test_empty_table(spark):
    assert periodic.periodic_runs(docs(spark, [])).collect() == []
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs(spark, []), 4, 2)
