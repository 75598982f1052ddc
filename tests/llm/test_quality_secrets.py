"""Quality by held-out rows, automata, and secrets against plain patterns."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tallyshelf.llm import quality, secret_scan
from tallyshelf.llm.automata import Automaton

from .fixtures import awkward, docs, real


def made_corpus(rng, n=600):
    """Prose and junk; a third are labelled, with 0 for junk."""
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        picked = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        good = rng.random() < 0.8
        if not good:
            picked = rng.choice([lambda: [w.upper() + "!!" for w in picked], lambda: [w + "$$$" for w in picked],
                                 lambda: [w for w in picked[:5] for _ in range(20)]])()
        rows.append((i, " ".join(picked)))
        if i % 3 == 0:
            labels.append((i, int(good), 0))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_classifier_separates_held_out_rows(spark):
    rows, labels = made_corpus(random.Random(3))
    out = quality.classify(docs(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    truth = {i: q for i, q, _ in labels}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.93


def test_labels_outside_the_fold_alone_count(spark):
    rows, labels = made_corpus(random.Random(4), 200)
    df = docs(spark, rows)
    fold = {r.doc_id for r in quality.classify(df, spark.createDataFrame(labels, LABELS)).collect() if r.held_out}
    turned = [(i, 1 - q if i in fold else q, 1) for i, q, _ in labels]
    a, b = ({r.doc_id: round(r.score, 6) for r in quality.classify(df, spark.createDataFrame(x, LABELS)).collect()}
            for x in (labels, turned))
    assert a == b
    assert all((i in fold) == (__import__("zlib").crc32(str(i).encode()) % 5 == 0) for i, _ in rows)


def test_prior_is_found(spark):
    rows, labels = made_corpus(random.Random(5), 1500)
    model = quality.train(docs(spark, rows), spark.createDataFrame(labels, LABELS))
    assert 0.7 < model.prior < 0.9


@pytest.mark.parametrize("labels", [[], [(1, 0, 0)], [(None, 1, 0), (2, None, 0)], [(1, 1, 0), (1, 1, 0), (2, 0, 1), (2, 1, 1)]])
def test_awkward_rows_and_few_labels(spark, labels):
    out = quality.classify(docs(spark, awkward()), spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == len(awkward()) and all(0 <= r.score <= 1 for r in out)
    if not any(q == 1 for _, q, _ in labels if _ is not None):
        assert {r.score for r in out} == {0.5}


def test_quality_of_nothing(spark):
    assert quality.classify(docs(spark, []), spark.createDataFrame([(1, 1, 0)], LABELS)).count() == 0


def test_automaton_learns_loops_and_prefixes():
    rng = random.Random(1)
    hexes = Counter("".join(rng.choice("0000aaa") for _ in range(40)) for _ in range(400))
    auto = Automaton(dict(hexes), secret_scan.SYMBOLS)
    assert len(auto.table) < 60
    good = "".join(rng.choice("0000aaa") for _ in range(40))
    assert auto.typical(good) and not auto.typical("g" * 40)
    assert auto.score(good) > auto.score("g" * 40) + 50
    fixed = Automaton({"AKG0": 50, "AKA0": 50}, secret_scan.SYMBOLS)
    assert abs(fixed.score("AKG0") - fixed.score("AKA0")) < 1e-9
    assert fixed.score("AKG0") > fixed.score("KAG0") + 5
    # Probabilities of the ends of all strings and of the rest add up to one.
    one = Automaton({"0": 3, "00": 1}, secret_scan.SYMBOLS)
    assert 0 < sum(2 ** one.score("0" * n) for n in range(6)) <= 1


def plain_base(text):
    """The contract's patterns, checked for length afterwards."""
    found = []
    for kind, pattern, least in (
        ("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
        ("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]+", 24),
    ):
        for m in re.finditer(pattern, text):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                found.append((m.start(), ["assign", "access", "hex"].index(kind), kind, m.end()))
    return [(k, a, b) for a, _, k, b in sorted(found)]


SECRETS = [
    'api_key = "abcdef12"', "PASSWORD: short", "token=abc token=abcdefg", "AKIA" + "A1" * 8, "AKIAAKIA" + "B2" * 9, "AKIA123",
    "deadbeef" * 3, "deadbeef" * 2, "paſſword=abcdefgh", "secret=secret=abcdef", "ü" * 5 + "apikey:'x/y+z=_'",
    "passwd  =  password=hunter22", "token = token = 0123456789abcdef01234567",
]


def test_base_spans_equal_the_plain_patterns(spark):
    rows = [(100 + n, s) for n, s in enumerate(SECRETS)] + [(200, " and ".join(SECRETS))] + awkward() + real()
    df = docs(spark, rows)
    out = secret_scan.scan(df, secret_scan.infer_formats(df)).collect()
    got = Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in out)
    want = Counter()
    for i, t in rows:
        base = plain_base(t or "")
        n = Counter(k for k, _, _ in base)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        want[i, n["assign"], n["access"], n["hex"], hashlib.sha256(text.encode()).hexdigest()] += 1
    assert got == want
    base_of = {i: plain_base(t or "") for i, t in rows}
    for r in out:
        spans = set(r.spans.split(",")) if r.spans else set()
        assert {f"{k}:{a}:{b}" for k, a, b in base_of[r.doc_id]} <= spans


def test_automata_add_unlabelled_credentials(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(16, 25)))
    key = lambda: "".join(rng.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(32))
    rows = [(i, f"{word()} {word()} token = {key()} and {word()}") for i in range(300)]
    bare = [(1000 + i, f"see {key()} or {word()} or {word()}") for i in range(100)]
    df = docs(spark, rows + bare)
    out = {r.doc_id: r for r in secret_scan.scan(df, secret_scan.infer_formats(df)).collect()}
    assert sum(out[i].spans.count("format:") == 1 and "format:4:36" in out[i].spans for i, _ in bare) >= 90
    assert sum("format" in out[i].spans for i, _ in rows) <= 5


def test_redacted_texts(spark):
    rows = [(1, 'use token = "abcdef1234" now'), (2, None), (3, "clean"), (4, "AKIA" + "A1" * 8 + " end"), (5, "")]
    df = docs(spark, rows)
    out = secret_scan.redact(df, secret_scan.infer_formats(df))
    assert out.columns == df.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {1: ('use [SECRET]" now', 17), 2: (None, None), 3: ("clean", 5), 4: ("[SECRET] end", 12), 5: ("", 0)}


def test_scan_of_nothing(spark):
    df = docs(spark, [])
    assert secret_scan.scan(df, secret_scan.infer_formats(df)).count() == 0
