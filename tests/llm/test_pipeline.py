"""The pipeline's stages, each on its own input, and its result."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from tallyshelf.llm import decontaminate, quality, secret_scan, simhash

from .fixtures import SF, docs, real
from .test_near_copies import plain_components
from .test_quality_secrets import plain_base
from .test_tokens_packing import check_packed


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("stages")
    frames = [spark.read.parquet(f"{SF}/documents.parquet")]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], SF).write.parquet(f"{home}/{n}")
        frames.append(spark.read.parquet(f"{home}/{n}"))
    return frames


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_all_but_the_last_return_documents(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_quality_stage(spark, stages):
    before, after = texts(stages[0]), texts(stages[1])
    scored = {r.doc_id: r.predicted for r in quality.classify(stages[0], spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert after == {i: before[i] for i, p in scored.items() if p}
    good = [i for i, q in real("labels", "doc_id, quality") if q == 1]
    assert sum(i in after for i in good) >= 0.9 * len(good)


def test_near_dedup_stage(stages):
    before, after = texts(stages[1]), texts(stages[2])
    ids = sorted(before)
    roots = plain_components([(i, before[i]) for i in ids])
    assert set(after) == {ids[r] for r in roots} and len(after) < len(before)


def test_repeated_and_unnamed_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "g h i j k l"), (2, "m n o p q r"), (None, "s t u v w x"),
            (None, "s t u v w x"), (3, None), (4, ""), (5, "A b c  d e f")]
    df = docs(spark, rows)
    left = corpus_pipeline.simhash_near_dedup(spark, df, SF)
    assert left.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == [
        (0, "s t u v w x"), (1, "a b c d e f"), (2, "g h i j k l"), (2, "m n o p q r"), (3, "")]


def test_leaks_go_by_row(spark):
    (item,) = [t for _, t in real("benchmark", "item_id, text")][:1]
    rows = [(1, "quite another text of some words"), (1, f"before it {item} behind it"), (None, item), (None, "clean words without an id")]
    left = corpus_pipeline.benchmark_decontamination(spark, docs(spark, rows), SF)
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == [(0, rows[3][1]), (1, rows[0][1])]


def test_decontamination_stage(stages):
    before, after = texts(stages[2]), texts(stages[3])
    bench = [" ".join(decontaminate.words_of(t)) for _, t in real("benchmark", "item_id, text")]
    leaking = {i for i, t in before.items() if any(f" {b} " in f" {' '.join(decontaminate.words_of(t))} " for b in bench)}
    assert leaking and set(after) == set(before) - leaking


def test_secret_stage(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(before) == set(after)
    for i, text in before.items():
        if not plain_base(text):
            assert len(after[i]) <= len(text)
        else:
            assert "[SECRET]" in after[i]
        assert not plain_base(after[i])


def test_packing_stage(stages):
    check_packed(list(texts(stages[4]).items()), stages[5].collect(), 2048)


def test_run(spark, stages):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).select(key).collect())) == Counter(map(tuple, stages[5].select(key).collect()))


@pytest.mark.parametrize("n", range(5))
def test_stages_take_awkward_tables(spark, n):
    from .fixtures import awkward

    name, stage = corpus_pipeline.STAGES[n]
    for rows in (awkward(), []):
        df = docs(spark, rows)
        out = stage(spark, df, SF)
        found = out.collect()
        assert n == 4 or out.columns == df.columns
        assert bool(found) == bool(rows)
    assert simhash and secret_scan and name


def test_run_keeps_the_last_rows_only(spark, monkeypatch):
    import os

    from tallyshelf.llm import common

    written, path = [], common.shared_path
    noted = lambda *a: written.append(path(*a)) or written[-1]
    monkeypatch.setattr(common, "shared_path", noted)
    monkeypatch.setattr(corpus_pipeline, "shared_path", noted)
    df = corpus_pipeline.run(spark, SF)
    # Before, every stage's rows and steps stayed until the application ended.
    names = lambda paths: {os.path.basename(x).split("-")[0] for x in paths}
    assert names(written) >= {"stage1", "stage2", "stage3", "stage4", "near", "features", "grams"}
    left = names(x for x in written if os.path.exists(x))
    assert "stage4" in left and not left & {"stage1", "stage2", "stage3", "near", "chosen", "features", "grams"}
    assert df.count() > 0
