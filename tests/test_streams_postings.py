"""Streams that keep a current table, and search by postings."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyshelf.operators import pages as P
from tallyshelf.operators import search
from tallyshelf.plans import postings
from tallyshelf.plans import warehouse as W
from tallyshelf.streaming import jobs, tables

from .test_warehouse import products, snap


def arrive(spark, rows, schema, folder):
    """One more file, and a stream over all of them, a file a batch."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_first_seen_over_many_batches(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "listing_id string, page int, seen_at int"
    rng = random.Random(1)
    want = {}
    for n in range(5):
        rows = [(rng.choice(["a", "b", "c", None, f"id{rng.randint(0, 30)}"]), n, rng.randint(0, 9)) for _ in range(40)]
        for key, page, at in sorted(rows, key=lambda r: r[2]):
            want.setdefault(key, (page, at))
        stream = arrive(spark, rows, schema, src)
        if n in (1, 4):  # restarts after several batches, too
            jobs.stream_first_seen_dedup(stream, "listing_id", out, state, order=["seen_at"])
    got = spark.read.parquet(out).collect()
    assert {r.listing_id: (r.page, r.seen_at) for r in got} == want and len(got) == len(want)
    assert not (tmp_path / "state" / "state").exists()  # nothing kept in the state store


def test_append_cut_off_half_way_is_completed(spark, tmp_path):
    out = str(tmp_path / "out")
    batch = spark.range(100).select(F.concat(F.lit("k"), "id").alias("id"), F.col("id").alias("n"))
    tables.append_new(batch.filter("n % 3 = 0"), out, "id")  # what was written before the loss
    for _ in range(2):
        tables.append_new(batch, out, "id")
    assert sorted(r.n for r in spark.read.parquet(out).collect()) == list(range(100))


def add_up(rows):
    return rows.groupBy("k", tables.PART).agg(F.sum("n").alias("n"))


def merged(spark, out, schema):
    return {r.k: r.n for r in tables.current(spark, out, schema).collect()}


def test_merge_is_repeated_from_what_was_written_ahead(spark, tmp_path):
    out, ahead = str(tmp_path / "out"), str(tmp_path / "ahead")
    batch = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n bigint")
    for number, times in ((0, 1), (1, 3), (2, 1)):
        for _ in range(times):  # a replayed batch is not added again
            tables.merge_batch(batch, number, out, ahead, "k", add_up)
    assert merged(spark, out, batch.schema) == {"a": 3, "b": 6}
    assert [p.name for p in (tmp_path / "ahead").iterdir() if not p.name.startswith(".")] == ["2"]
    # The table's parts are lost while they are overwritten: the replay brings them back.
    for folder in (tmp_path / "out").glob(f"{tables.PART}=*"):
        tables.remove(spark, str(folder))
    tables.merge_batch(batch, 2, out, ahead, "k", add_up)
    assert merged(spark, out, batch.schema) == {"a": 3, "b": 6}
    tables.merge_batch(batch.limit(0), 3, out, ahead, "k", add_up)
    assert merged(spark, out, batch.schema) == {"a": 3, "b": 6}


def test_merge_overwrites_touched_parts_only(spark, tmp_path):
    out, ahead = str(tmp_path / "out"), str(tmp_path / "ahead")
    many = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(1).cast("bigint").alias("n"))
    tables.merge_batch(many, 0, out, ahead, "k", add_up)
    files = lambda: {str(p) for p in (tmp_path / "out").rglob("*.parquet")}
    before = files()
    assert len({p.split("/")[-2] for p in before}) == tables.PARTS
    tables.merge_batch(many.filter("k = 'k77'"), 1, out, ahead, "k", add_up)
    assert len({p.split("/")[-2] for p in before - files()}) == 1
    assert merged(spark, out, many.schema) == {f"k{n}": 1 + (n == 77) for n in range(5000)}


def test_progress_over_many_batches_keeps_one_row_per_keyword(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "keyword string, offset int, results int, total int, fetched_at timestamp, event_id bigint"
    rng, rows = random.Random(3), []
    for n in range(5):
        new = [(f"k{rng.randint(0, 8)}", 100 * rng.randint(0, 9), rng.choice([0, 50, 100]), rng.choice([None, 600]),
                datetime(2026, 1, 1) + timedelta(hours=rng.randint(0, 50)), 100 * n + i) for i in range(20)]
        stream = arrive(spark, new + rows[:5], schema, src)  # pages that came before come again
        rows += new
        found = jobs.stream_keyword_progress(stream, out, state, page_size=100).collect()
    newest = {r[0]: r for r in sorted(rows, key=lambda r: r[4:])}
    assert {r.keyword: (r.next_offset, r.updated_at) for r in found} == {k: (r[1] + r[2], r[4]) for k, r in newest.items()}
    for r in found:
        _, offset, results, total, *_ = newest[r.keyword]
        assert r.completed == (results < 100 or (total is not None and offset + results >= total))
    assert len(found) == len(newest) and spark.read.parquet(out).count() == len(newest)
    assert not (tmp_path / "state" / "state").exists()


def test_days_close_and_late_rows_are_merged(spark, tmp_path):
    day = lambda d, n: (d and datetime(2026, 10, d, 5), n, 1)
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "recorded_at timestamp, http_attempts bigint, http_429 bigint"
    for rows in ([day(1, 5), day(2, 3)], [day(3, 1), day(1, 1)], [day(20, 1)], [day(1, 7), day(19, 2), day(None, 4)], [day(1, 1)]):
        found = jobs.stream_daily_metrics(arrive(spark, rows, schema, src), out, state)
    got = {r.day and r.day.day: (r.http_attempts, r.http_429, r.late_rows, r.closed) for r in found.collect()}
    assert got == {1: (14, 4, 2, True), 2: (3, 1, 0, True), 3: (1, 1, 0, True), 19: (2, 1, 0, False), 20: (1, 1, 0, False),
                   None: (4, 1, 0, None)}
    assert spark.read.parquet(out).count() == len(got)


NAMES = ["Steel Bolt M8", "steel bolt m8 XL", "boltbolt", "bol", "", None, "STRAẞE Öl", "straße öl", "aaa aaaa", "100% wool_x", "İstanbul ring",
         "ring-ring-ring", "gear 🎁🎁🎁 box"]


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("shop")
    wh = W.Warehouse(spark, str(root / "wh"))
    rows = [snap("ebay", f"P{n}", 10 + n % 3, float(n), product_name=name or f"name {n}", category="Rings" if n % 4 else None)
            for n, name in enumerate(NAMES * 3)]
    W.load_fact_external(wh, products(spark, *rows))
    postings.write_postings(wh, str(root / "postings"))
    return wh, str(root / "postings")


@pytest.mark.parametrize("q", ["bolt", "BOLT M8", "olt", "aaa", "aaaa", "a a", "öl", "straße", "STRAẞE", "ring-ring", "🎁🎁🎁", "l 🎁", "100%", "l_x",
                               "rings", "P1", "name 4", "no such name", "i̇st", "istanbul", ""])
def test_postings_find_what_a_scan_finds(spark, shop, q):
    wh, path = shop
    found = postings.read_postings(spark, path)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(postings.product_search(wh, found, q, min_price=2.0)) == rows(search.product_search(wh.frames(), q, min_price=2.0))
    fields = ["product_name", "brand", "category"]
    keys = postings.holding(found, q, fields)
    assert (keys is None) == (len(q) < 3 or "%" in q or "_" in q)
    if keys is not None:
        scan = wh.read("dim_product").filter(search._contains(q, *fields)).select("product_key")
        assert sorted(r.product_key for r in keys.collect()) == sorted(r.product_key for r in scan.collect())


def test_a_search_reads_postings_and_the_parts_that_match(spark, shop):
    wh, path = shop
    keys = postings.holding(postings.read_postings(spark, path), "boltb", ["product_name"])
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "In(piece" in plan.split("PushedFilters: ")[1] and "dim_product" not in plan
    found = postings.products_holding(wh, postings.read_postings(spark, path), "boltb", ["product_name"])
    parts = {r[0] for r in keys.select(postings.PART).distinct().collect()}
    filters = re.search(r"PartitionFilters: \[[^\]]*_part#\d+ IN \(([\d,]+)\)", found._jdf.queryExecution().executedPlan().toString())
    assert found.count() == 3 and set(map(int, filters[1].split(","))) == parts and len(parts) < W.PARTS


def test_postings_of_overwritten_parts_are_written_anew(spark, tmp_path):
    wh, path = W.Warehouse(spark, str(tmp_path / "wh")), str(tmp_path / "postings")
    W.load_fact_external(wh, products(spark, *[snap("ebay", str(n), 10, product_name=f"lamp {n}") for n in range(60)]))
    postings.write_postings(wh, path)
    part = wh.parts("dim_product").filter("source_product_id = '7'").select(postings.PART).first()[0]
    untouched = {str(p) for p in (tmp_path / "postings").rglob("*.parquet") if f"{postings.PART}={part}/" not in str(p)}
    W.upsert_fact_external(wh, products(spark, snap("ebay", "7", 11, product_name="torch seven")))
    postings.write_postings(wh, path, [part])
    found = postings.read_postings(spark, path)
    hits = lambda q: postings.holding(found, q, ["product_name"]).count()
    assert (hits("torch sev"), hits("lamp"), hits("lamp 7")) == (1, 59, 0)
    assert untouched <= {str(p) for p in (tmp_path / "postings").rglob("*.parquet")}


def test_redirects_of_a_page_with_many_ids(spark):
    rng = random.Random(4)
    ids = [str(rng.randint(1, 400)) for _ in range(1500)]
    html = "🎁" + "".join(f"<a href='{'https://PRICEZA.com' * (n % 2)}/r/redirect?id={i}'>x</a> ฿ {n}" for n, i in enumerate(ids))
    df = spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "/r/redirect?id=x")], "page_id bigint, html string")
    got = {r.redirect_id: r for r in P.redirect_price_candidates(df, around=40).collect()}
    assert set(got) == set(ids)
    for i, r in got.items():
        start = min(html.find(a) for a in (f"https://PRICEZA.com/r/redirect?id={i}'", f"'/r/redirect?id={i}'") if a in html)
        assert r.position == start + (html[start] == "'")
        assert r.nearby_prices[-1].startswith("฿") or r.nearby_prices == []
    plan = P.redirect_price_candidates(df)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "MapInArrow" in plan


def test_products_are_dealt_before_their_fields_are_cut(spark, shop):
    wh, path = shop
    rows = postings.dealt_pieces(wh)
    plan = rows.select("*")._jdf.queryExecution().executedPlan().toString().split("\n")
    dealt, cut = ([n for n, line in enumerate(plan) if word in line] for word in ("Exchange", "Generate"))
    # Before, every piece of every field was dealt, with its field's name.
    assert len(dealt) == 1 and cut and max(cut) < dealt[0]
    assert sorted(map(str, rows.collect())) == sorted(map(str, postings.pieces(wh.parts("dim_product")).collect()))
    placed = rows.withColumn("task", F.spark_partition_id()).groupBy("product_key").agg(F.countDistinct("task").alias("n"))
    assert placed.filter("n > 1").isEmpty() and spark.read.parquet(path).count() == rows.count()
