"""Decontamination, line dedup, URL lists and top-k against brute force."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyshelf.llm import decontaminate, line_dedup, topk, url_filter

from .fixtures import awkward, docs, real


# --- decontamination ---------------------------------------------------------------------


def plain_alignment(a, b):
    """Smith-Waterman cell by cell."""
    best, above = 0, [0] * (len(a) + 1)
    for y in b:
        row = [0]
        for j, x in enumerate(a):
            row.append(max(0, above[j] + (2 if x == y else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best


def test_alignment_equals_the_plain_one():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcde") for _ in range(rng.randint(1, 25))] for _ in range(2))
        assert decontaminate.align(a, b)[0] == plain_alignment(a, b)


def items():
    rng = random.Random(7)
    return [(i, " ".join(f"t{rng.randint(0, 4000)}" for _ in range(rng.randint(12, 40)))) for i in range(30)]


def test_leaks_equal_brute_force(spark):
    rng = random.Random(8)
    bench = items()
    rows = []
    for i in range(200):
        words = [f"t{rng.randint(0, 4000)}" for _ in range(rng.randint(5, 200))]
        if i % 3 == 0:
            item = bench[i % 30][1].split()
            kind = i % 4
            if kind == 1:  # every sixth word replaced
                item = [w if k % 6 else "new" for k, w in enumerate(item)]
            elif kind == 2:  # words put in
                item = [x for k, w in enumerate(item) for x in ([w, "extra"] if k % 5 == 4 else [w])]
            elif kind == 3:  # the first half only
                item = item[: len(item) // 2 + 3]
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() + "," for w in item]
        rows.append((i, " ".join(words)))
    rows += [(i + 1000 if i is not None else None, t) for i, t in awkward()]
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leaks(
        docs(spark, rows), spark.createDataFrame(bench, "item_id long, text string")).collect()}
    want = {}
    for i, t in rows:
        words = decontaminate.words_of(t)
        if len(words) > 5000:
            continue
        for item, text in bench:
            b = decontaminate.words_of(text)
            s = plain_alignment(words, b) / (2 * len(b)) if words else 0
            if s >= 0.5:
                want[i, item] = s
    assert len(want) > 50
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_common_words_keep_seeds(spark):
    """An item whose grams are all in very many documents is still found."""
    item = "the of and to in is it that was for on are as with his they"
    rows = [(i, f"w{i} {item} v{i}") for i in range(300)] + [(999, "something else altogether here")]
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "two words"), (1, item)], "item_id long, text string")
    got = decontaminate.leaks(docs(spark, rows), bench, rare_docs=5).collect()
    assert sorted((r.doc_id, r.item_id, r.similarity) for r in got) == [(i, 1, 1.0) for i in range(300)]


def test_no_leaks_without_rows(spark):
    bench = spark.createDataFrame(items(), "item_id long, text string")
    assert decontaminate.leaks(docs(spark, []), bench).count() == 0
    assert decontaminate.leaks(docs(spark, awkward()), bench.limit(0)).count() == 0
    assert decontaminate.leaks(docs(spark, awkward()), bench).count() == 0


# --- passage dedup -------------------------------------------------------------------------


def plain_units(text, unit):
    """(start, end, words) of units, character by character."""
    bounds, at, n = [], 0, len(text)
    for i, c in enumerate(text):
        if c == "\n" or (unit == "sentence" and c.isspace() and i and text[i - 1] in ".!?"):
            bounds.append((at, i))
            at = i + 1
    return [(a, b, text[a:b].lower().split()) for a, b in [*bounds, (at, n)]]


def plain_passages(rows, unit, min_words, min_run):
    held, per_row = defaultdict(list), {}
    for n, (i, t) in enumerate(dict.fromkeys(rows)):
        kept, count = [], 0
        for a, b, words in plain_units(t or "", unit):
            if len(words) >= min_words:
                lead = len(t[a:b]) - len(t[a:b].lstrip())
                kept.append((a + lead, a + lead + len(t[a:b].strip()), count, count + len(words), " ".join(words)))
            count += len(words)
        per_row[n] = (i, kept)
        for k, u in enumerate(kept):
            held[u[4]].append((i is None, i or 0, n, k))
    want = Counter()
    for n, (i, kept) in per_row.items():
        run = []
        for k, u in enumerate([*kept, None]):
            keeper = min(held[u[4]])[:2] if u else None
            first = u and all(v[4] != u[4] for v in kept[:k])
            repeat = u and len(held[u[4]]) > 1 and not (first and (i is None, i or 0) == keeper)
            if repeat:
                run.append((u, None if keeper[0] else keeper[1]))
            elif run:
                words = run[-1][0][3] - run[0][0][2]
                if words >= min_run:
                    keepers = [x for _, x in run if x is not None]
                    want[i, run[0][0][0], run[-1][0][1], words, min(keepers, default=None)] += 1
                run = []
    return want


@pytest.mark.parametrize("unit, min_words, min_run", [("line", 3, 3), ("sentence", 2, 6), ("sentence", 1, 1), ("sentence", 4, 25)])
def test_passages_equal_brute_force(spark, unit, min_words, min_run):
    rng = random.Random(2)
    word = lambda: rng.choice(["aa", "bb", "cc", "Dd", "ee"])
    pool = [" ".join(word() for _ in range(rng.randint(1, 9))) + rng.choice([".", "!", "?", ".", ""]) for _ in range(40)]
    rows = [(i, "".join(rng.choice(pool) + rng.choice([" ", "  ", "\n", "\t"]) for _ in range(rng.randint(0, 12)))) for i in range(80)]
    rows += [(i + 100 if i is not None else None, t) for i, t in awkward() if not t or len(t) < 1000]
    rows += [(61, "AA  bb cc\n\naa bb\tcc"), (None, "aa bb cc. aa bb cc."), (None, "aa bb cc."), rows[5], rows[6], (70, rows[6][1])]
    got = Counter(map(tuple, line_dedup.repeated_passages(docs(spark, rows), unit, min_words, min_run).collect()))
    assert got == plain_passages(rows, unit, min_words, min_run)


def test_passages_inside_lines_are_found_and_formulas_stay(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(f"w{rng.randint(0, 9999)}" for _ in range(n)) + "."
    passage = " ".join(text(14) for _ in range(4))
    rows = [(i, f"{text(30)} All rights reserved by us. {text(20)} unfinished{i}{'.' if i % 2 else ''} {passage} {text(9)}") for i in range(200)]
    found = line_dedup.repeated_passages(docs(spark, rows)).collect()
    assert sorted(r.doc_id for r in found) == list(range(1, 200))
    for r in found:
        cut = rows[r.doc_id][1][r.start:r.end]
        assert cut in passage and len(cut.split()) >= 42 and r.kept_doc_id in (0, 1)


def test_paragraphs_and_cut_texts(spark):
    rows = [(1, "one two three\nfour\n\nfive six seven"), (2, "x\n\nONE two  three\nfour\n \nend of it"), (3, None), (4, "one two three")]
    df = docs(spark, rows)
    removed = line_dedup.repeated_passages(df, "paragraph", 3, 3)
    assert [(r.doc_id, r.start, r.end, r.kept_doc_id) for r in removed.collect()] == [(2, 3, 22, 1)]
    lines = line_dedup.repeated_passages(df, "line", 3, 3)
    cut = {r.doc_id: (r.text, r.cuts and [(c.start, c.end) for c in r.cuts]) for r in line_dedup.without_passages(df, lines).collect()}
    assert cut == {1: (rows[0][1], None), 2: ("x\n\nfour\n \nend of it", [(3, 17)]), 3: (None, None), 4: ("", [(0, 13)])}
    assert line_dedup.repeated_passages(docs(spark, [])).count() == 0


# --- URL lists -----------------------------------------------------------------------------


def plain_lists(url, at, entries):
    host = url.split("://", 1)[1].split("/", 1)[0].split("@")[-1].split(":")[0].lower()
    path = "/".join(p for p in (url.split("://", 1)[1] + "/").split("/", 1)[1].split("?")[0].split("/") if p)
    found = []
    state = {}
    for name, pattern, action, when in sorted(set(entries), key=lambda e: (e[3], e[2])):
        if when <= at:
            state[name, pattern] = action
    for (name, pattern), action in state.items():
        on = pattern == host or host.endswith("." + pattern) or (
            "/" in pattern and (host + "/" + path + "/").startswith(pattern + "/"))
        if action == "add" and on:
            found.append(name)
    return sorted(set(found)), len(found)


def test_lists_equal_brute_force(spark):
    rng = random.Random(4)
    hosts = ["a.com", "b.a.com", "c.b.a.com", "other.org"]
    patterns = hosts + ["com", "a.com/x", "a.com/x/y", "b.a.com/x", "other.org/q"]
    entries = [(rng.choice(["l1", "l2"]), rng.choice(patterns), rng.choice(["add", "remove"]), rng.randint(0, 20)) for _ in range(60)]
    urls = [f"http://{rng.choice(['', 'me@'])}{rng.choice(hosts).upper()}{rng.choice(['', ':80'])}/{p}" for p in
            ("", "x", "x/y", "x/y/z?q=/w", "xy", "q", "q/r", "/x//y") for _ in range(4)]
    rows = [(n, u, rng.randint(0, 22)) for n, u in enumerate(urls)] * 2 + [(900, None, 3), (901, urls[0], None), (902, "no url", 3)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, fetched_at long, lists string, u int")
    listed = spark.createDataFrame(entries + [(None, "a.com", "add", 1), ("l1", "a.com", "pause", 2)], "list_name string, pattern string, action string, at long")
    out = url_filter.evaluate(df, listed)
    assert out.columns == [*df.columns, "lists_", "n_entries"]
    got = Counter((r.page_id, tuple(r.lists_), r.n_entries) for r in out.collect())
    want = Counter()
    for i, u, t in rows:
        names, n = plain_lists(u, t, entries) if u and t is not None and "://" in u else ([], 0)
        want[i, tuple(names), n] += 1
    assert got == want


def test_lists_of_nothing(spark):
    pages = spark.createDataFrame([(1, "http://a.com/", 1)], "page_id long, url string, fetched_at long")
    none = spark.createDataFrame([], "list_name string, pattern string, action string, at long")
    assert [r.n_entries for r in url_filter.evaluate(pages, none).collect()] == [0]
    assert url_filter.evaluate(pages.limit(0), none).count() == 0
    # A very long path is cut only as deep as the lists go.
    deep = spark.createDataFrame([(1, "http://a.com/" + "x/" * 50_000, 5)], pages.schema)
    listed = spark.createDataFrame([("l", "a.com/x/x", "add", 1)], none.schema)
    assert [r.n_entries for r in url_filter.evaluate(deep, listed).collect()] == [1]


# --- top-k ---------------------------------------------------------------------------------


def plain_top(rows, k, step):
    codes = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        c = [math.floor(64 * x) for x in v]
        codes[i] = min(codes.get(i, c), c)
    want = set()
    for q, a in codes.items():
        if q % step == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in codes.items() if i != q)
            want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return want


def top(spark, rows, k, step):
    df = spark.createDataFrame([(*r, "x", 0.5) for r in rows], "vec_id long, embedding array<double>, codes string, norm double")
    v = topk.quantised(df, "vec_id", "embedding")
    return {tuple(r) for r in topk.top_k(v, v.filter(F.col("vec_id") % step == 0), k).collect()}


@pytest.mark.parametrize("block", [4096, 7])
@pytest.mark.parametrize("coordinates", [0.6, 0.0, 2.0])
def test_search_equals_brute_force(spark, monkeypatch, block, coordinates):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    monkeypatch.setattr(topk, "PROBES", 30)
    monkeypatch.setattr(topk, "COORDINATES_FROM", coordinates)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] * (1 + i % 5) + 0.2 * rng.normal(size=8)).tolist()) for i in range(240)]
    rows += [(300 + i, [1.0] * 8) for i in range(60)]  # ties
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (None, [1.0] * 8), (404, []),
             (405, [0.0] * 8), (406, [2.0, 1.0]), (410, rows[0][1]), (410, rows[1][1]), (410, rows[1][1])]
    assert top(spark, rows, 5, 10) == plain_top(rows, 5, 10)


def test_few_negative_and_huge(spark):
    assert top(spark, [], 3, 1) == set()
    assert top(spark, [(1, [1.0])], 3, 1) == set()
    rows = [(i, [float(-i), 1.0]) for i in range(1, 5)] + [(9, [-1.0, -1.0])]
    assert top(spark, rows, 20, 1) == plain_top(rows, 20, 1)
    big = [(1, [1e9, 3.0]), (2, [1e9, 2.0]), (3, [-1e9, 1.0]), (4, [1e6 + 1, 1e7])]
    got = top(spark, big, 2, 1)
    most = 2**63 - 1
    assert got == {(q, r, i, max(-most - 1, min(most, s))) for q, r, i, s in plain_top(big, 2, 1)}


def test_real_vectors(spark):
    rows = [(i, list(v)) for i, v in real("embeddings", "vec_id, embedding")]
    assert top(spark, rows, 20, 20) == plain_top(rows, 20, 20)


def test_items_without_spaces_and_short_ones(spark):
    rng = random.Random(8)
    hyphened = "-".join(f"w{rng.randint(0, 9999)}" for _ in range(60))
    parts = hyphened.split("-")
    edited = "-".join(p if k % 7 else "zz" for k, p in enumerate(parts))
    chinese = "这是一个没有空格的句子用来检查基准测试的泄漏"
    items = [(1, hyphened), (2, chinese), (3, "two words"), (4, "Single")]
    rows = [(10, f"some text before {edited} and after"), (11, f"前面的文字{chinese}后面的文字"), (12, chinese), (13, "Two  words"), (14, "single"),
            (15, "a longer text that holds two words and a single one"), (16, "完全不同的另外一些文字在这里没有关系")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs(spark, rows), bench).collect()}
    assert found == {(10, 1), (11, 2), (12, 2), (13, 3), (14, 4)}
