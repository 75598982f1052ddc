"""Short credentials, values behind names and in paths, and what stands beside a base span."""

from __future__ import annotations

import random
from collections import Counter

from tallyshelf.llm import secret_scan


def test_candidates_of_any_labelled_length():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(6, 25)))
    key = lambda n: "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(n))
    form = lambda token: token.translate(secret_scan._CLASSES)
    pairs = Counter(x + y for f in (form(word()) for _ in range(2000)) for x, y in zip("^" + f, f + "$"))
    formats = secret_scan.Formats({"assign": Counter(form(key(n)) for _ in range(400) for n in (12, 32))}, pairs, 16.0)

    def spans(text):
        return [(a, b) for kind, a, b in secret_scan.spans_of(text, formats)[1] if kind == "format"]

    short = [spans(f"see {key(12)} or {word()}") for _ in range(50)]
    assert sum(s == [(4, 16)] for s in short) >= 40
    named = [spans(f"see aws_key={key(32)} or http://host.com/{key(32)}/{word()}") for _ in range(50)]
    assert sum(s == [(12, 44), (64, 96)] for s in named) >= 40
    assert sum(bool(spans(f"{word()} {word()}")) for _ in range(500)) <= 10


def test_rest_beside_a_base_span():
    text = "ghp_" + "0a1b2c3d" * 3 + "XYZW9988"
    base = secret_scan.base_spans(text)
    assert [(a, b, left) for a, b, left in secret_scan._runs(text, base)] == [(0, 36, [(0, 4), (28, 36)])]
    formats = secret_scan.Formats({"assign": {"GGGG0000": 500}}, {"^g": 500, "gg": 3000, "g$": 500}, 16.0)
    assert secret_scan.spans_of(text, formats)[1] == [("hex", 4, 28), ("format", 28, 36)]


def test_remembered_runs_change_nothing(monkeypatch):
    rng = random.Random(9)
    key = lambda n: "".join(rng.choice("ABCDEFGHabcdefgh0123456789") for _ in range(n))
    pool = ["plainword", "another/plain.word", "x=y", "PassWord=", "tokens:", "key: ", "AKIA", "AKIA" + "Q7" * 9, "0a1b" * 6, "0a1b" * 5, "\u212aey="]
    pool += [key(n) for n in (5, 6, 12, 32)] + ["name=" + key(32), "a/" + key(12) + ".b", "ghp_" + "0a1b" * 7 + "XYZ9" + key(12)]
    texts = ["".join(rng.choice(pool) + rng.choice([" ", "", "\n", ", "]) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    examples = {"assign": Counter(key(n).translate(secret_scan._CLASSES) for _ in range(400) for n in (12, 32))}
    fresh = lambda: secret_scan.Formats(examples, {"^g": 500, "gg": 3000, "g$": 500}, 16.0)
    for bound in (secret_scan.REMEMBERED, 3):
        monkeypatch.setattr(secret_scan, "REMEMBERED", bound)
        kept, judge, some = fresh(), fresh(), 0
        for text in texts:
            base = [("assign", *m.span()) for m in secret_scan._ASSIGN.finditer(text) if len(m[2]) >= 6]
            base += [("access", *m.span()) for m in secret_scan._ACCESS.finditer(text)]
            base += [("hex", *m.span()) for m in secret_scan._HEX.finditer(text)]
            want = [span for run in secret_scan._runs(text, base) for span in judge._inside(text, *run)]
            some += len(want)
            assert secret_scan.spans_of(text, kept) == (base, base + [("format", a, b) for a, b in want])
        assert some > 100 and len(kept.plain) <= bound
