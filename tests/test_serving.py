"""Ranking, search, files and streams."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyshelf import schemas as S
from tallyshelf.operators import recommend as R
from tallyshelf.operators.joins import convert_currency
from tallyshelf.operators import search
from tallyshelf.operators.gates import GateError
from tallyshelf.plans import warehouse as W
from tallyshelf.sources import readers, writers
from tallyshelf.streaming import jobs

from .test_warehouse import products, snap

ITEMS = "request_id int, external_fact_key int, currency string, price double, rating double, review_count int"


def test_ranking_scores(spark):
    items = spark.createDataFrame([(1, 1, "USD", 10.0, 5.0, 1000), (1, 2, "USD", 20.0, 2.5, None), (2, 3, "USD", 5.0, None, 100),
                                   (2, 4, "USD", 5.0, None, None)], ITEMS)
    rows = {r.external_fact_key: r for r in R.recommend_products(items).collect()}
    assert (rows[1].score, rows[1].rank, rows[2].score, rows[2].rank) == (0.85, 1, 0.175, 2)
    assert (rows[3].score, rows[4].score) == (0.015, 0.0)  # equal prices add nothing
    assert rows[4].reasons == ["has price"]


def test_guard(spark):
    rows = [(1, 1, "USD", 1.0), (1, 2, None, None), (2, 1, "USD", 1.0), (2, 2, "GBP", 1.0), (3, 1, "USD", 1.0)]
    rows += [(4, i, "USD", 1.0) for i in range(5000)] + [(5, 1, "THB", 1.0), (5, 2, "USD", 1.0), (6, 1, "XXX", 1.0), (6, 2, "USD", 1.0)]
    items = spark.createDataFrame([(*r, 1.0, 1) for r in rows], ITEMS)
    why = {r.request_id: r.limitation for r in R.ranking_guard(items, sizes=(2, 5)).collect()}
    assert why == {1: "missing price or currency", 2: "several currencies", 3: "request must name 2 to 5 products",
                   4: "request must name 2 to 5 products", 5: "several currencies", 6: "several currencies"}
    rates = spark.createDataFrame([("USD", "THB", Decimal("33.5"), date(2026, 10, 11)), ("GBP", "THB", Decimal("44"), date(2026, 10, 10))],
                                  "base string, target string, rate decimal(18,6), rate_date date")
    why = {r.request_id: r.limitation for r in R.ranking_guard(items, "thb", rates, (2, 5)).collect()}
    assert (why[2], why[5], why[6]) == ("exchange rate dates differ", None, "exchange rate unavailable")
    ranked = R.recommend_products(items, "price", "thb", rates, (2, 5)).collect()
    assert len(ranked) == len(rows) and {r.request_id for r in ranked if r.rank} == {5}
    assert all((r.limitation is None) == (r.rank is not None) == (r.score is not None) for r in ranked)
    # Without a bound, large and single requests are ranked as well.
    assert {r.request_id for r in R.recommend_products(items).collect() if r.rank} == {3, 4}


def test_rates_are_not_met_by_a_shuffle_on_currency(spark):
    items = spark.createDataFrame([(1, 1, "USD", 10.0, 5.0, 1)], ITEMS)
    rates = spark.createDataFrame([("USD", "THB", Decimal("33"), date(2026, 10, 11)), ("USD", "THB", Decimal("31"), date(2026, 10, 9)),
                                   (None, "THB", Decimal("1"), date(2026, 10, 9))],
                                  "base string, target string, rate decimal(18,6), rate_date date")
    converted = convert_currency(items, rates)
    assert [float(r.price_converted) for r in converted.collect()] == [330.0]
    plan = converted._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_search_conditions_concern_the_latest_fact(spark, tmp_path):
    wh = W.Warehouse(spark, str(tmp_path / "wh"))
    W.load_fact_external(wh, products(spark, snap("ebay", "1", 10, 50.0), snap("ebay", "1", 11, 90.0), snap("etsy", "2", 10, 60.0)))
    frames = wh.frames()
    assert search.product_search_total(frames, max_price=70.0).first().total == 1  # the old price of 1 does not count
    rows = search.product_search_page(frames, sort="price_desc", size=1, page=2).collect()
    assert [float(r.price) for r in rows] == [60.0]
    assert search.product_search_total(frames, q="N1").first().total == 1
    for bad in ({"platforms": ["nowhere"]}, {"min_price": 2.0, "max_price": 1.0}):
        with pytest.raises(ValueError):
            search.product_search(frames, **bad)
    with pytest.raises(ValueError):
        search.product_search_page(frames, size=51)


def test_optional_source(spark, tmp_path):
    assert readers.read_optional_source(spark, str(tmp_path / "none"), "x") is None
    (tmp_path / "empty").mkdir()
    assert readers.read_optional_source(spark, str(tmp_path / "empty"), "x") is None
    with pytest.raises(RuntimeError):
        readers.read_available_sources(spark, {"x": str(tmp_path / "none")})
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "a.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        readers.read_optional_source(spark, str(broken), "x").count()


def test_csv_is_strict(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text('id,title\n1,"a ""quoted""\nline"\n', encoding="utf-8")
    assert readers.read_csv_strict(spark, str(good), ["id"]).first().title == 'a "quoted"\nline'
    with pytest.raises(GateError):
        readers.read_csv_strict(spark, str(good), ["price"])
    bad = tmp_path / "bad.csv"
    bad.write_text("id,title\n1,a,b,c\n")
    with pytest.raises(Exception):
        readers.read_csv_strict(spark, str(bad), ["id"]).collect()


def test_write_once_and_quoted_csv(spark, tmp_path):
    df = spark.createDataFrame([("a\"b", None), ("", "x")], "k string, v string")
    writers.write_quoted_csv(df, str(tmp_path / "csv"), files=1)
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("part-*"))
    assert '"a""b",\\N' in text.replace('"\\N"', "\\N")
    with pytest.raises(AnalysisException):
        writers.write_quoted_csv(df, str(tmp_path / "csv"))
    writers.write_once(df, str(tmp_path / "once"))
    with pytest.raises(AnalysisException):
        writers.write_once(df, str(tmp_path / "once"))


def test_unprepared_snapshots(spark):
    ins = spark.createDataFrame([("/raw/a.json",), ("/raw/b.json",)], "path string")
    outs = spark.createDataFrame([("/out/a",)], "path string")
    assert [r.path for r in readers.list_unprepared_snapshots(ins, outs).collect()] == ["/raw/b.json"]


def test_price_list_document(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"dataset": "x", "products": [\n{"external_product_id": "A1", "price": 5.0}, {"external_product_id": "A2"}]}')
    rows = readers.read_multiline_json_products(spark, str(tmp_path), S.PRICE_LIST_JSON)
    assert sorted(r.external_product_id for r in rows.collect()) == ["A1", "A2"]


def test_ingest_reads_each_file_once(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = products(spark, snap("ebay", "1", 10)).drop("observation_date")
    for expected in (1, 1, 2):
        if expected == 2:
            rows.write.mode("append").parquet(src)
        elif not (tmp_path / "in").exists():
            rows.write.parquet(src)
        jobs.incremental_snapshot_ingest(spark, src, out, state, "ebay")
        assert spark.read.parquet(out).count() == expected


def test_seen_ids_are_remembered_between_runs(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "listing_id string, page int"
    for rows in ([("a", 1), ("a", 1), ("b", 1)], [("b", 2), ("c", 2)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        jobs.stream_first_seen_dedup(stream, "listing_id", out, state)
    assert sorted(r.listing_id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_replayed_batch_is_not_repeated(spark, tmp_path):
    out, batch = str(tmp_path / "out"), spark.range(5)
    jobs.write_batch(batch, 0, out)
    jobs.write_batch(batch, 0, out)
    assert spark.read.parquet(out).count() == 5


def test_stream_load_equals_batch_load(spark, tmp_path):
    rows = products(spark, snap("ebay", "1", 10), snap("ebay", "1", 10, 2.0), snap("etsy", "2", 11))
    rows.write.parquet(str(tmp_path / "in"))
    wh = W.Warehouse(spark, str(tmp_path / "wh"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    for state in ("s1", "s2"):  # a lost checkpoint replays batch 0
        jobs.stream_fact_load(stream, wh, str(tmp_path / state), "facts")
    assert wh.read("fact_external_product").count() == 2
    assert wh.head()["version"] == 1
    assert wh.head()["batches"] == {"facts": 0}
    assert not list((tmp_path / "wh" / "scratch").glob("*"))


def test_late_rows_of_a_day_count_and_replays_do_not(spark, tmp_path):
    day = lambda d, n: (datetime(2026, 10, d, 5), n, 1)
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "recorded_at timestamp, http_attempts bigint, http_429 bigint"
    for rows in ([day(1, 5), day(20, 1)], [day(1, 7)]):  # nineteen days late
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        found = jobs.stream_daily_metrics(stream, out, state)
    assert sorted((r.day.day, r.http_attempts, r.http_429) for r in found.collect()) == [(1, 12, 2), (20, 1, 1)]


@pytest.mark.parametrize("offset, results, total, done", [
    (0, 0, None, True), (0, 99, None, True), (0, 100, None, False), (11_900, 100, None, False), (11_901, 100, None, True),
    (100, 100, 200, True), (100, 100, 201, False),
])
def test_completion_of_a_keyword(spark, tmp_path, offset, results, total, done):
    schema = "keyword string, offset int, results int, total int, fetched_at timestamp, event_id bigint"
    rows = [("k", offset, results, total, datetime(2026, 1, 2), 2), ("k", 0, 0, None, datetime(2026, 1, 1), 9)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    row = jobs.stream_keyword_progress(stream, str(tmp_path / "out"), str(tmp_path / "state"), page_size=100).first()
    assert (row.next_offset, row.completed) == (offset + results, done)


@pytest.mark.parametrize("sort", ["recent", "price_asc", "price_desc", "rating", "reviews"])
def test_cursor_pages_equal_offset_pages(spark, tmp_path, sort):
    cells = [(None, None, None), (5.0, 3.0, 7), (5.0, None, 7), (9.0, 4.5, None), (1.0, 3.0, 0)]
    rows = [snap("ebay", str(n), 10 + n % 3, p, rating=r, review_count=c) for n, (p, r, c) in enumerate(cells * 3)]
    wh = W.Warehouse(spark, str(tmp_path / "wh"))
    W.load_fact_external(wh, products(spark, *rows))
    frames = wh.frames()
    cursor, page = None, 0
    while page == 0 or cursor:
        page += 1
        got = search.product_search_after(frames, sort, cursor, 4)
        assert got.items == search.product_search_page(frames, sort, page, 4).collect() and got.total == 15
        cursor = got.next
    assert page == 4
    none = search.product_search_after(frames, sort, None, 4, q="no such name")
    assert (none.items, none.total, none.next) == ([], 0, None)


def test_pages_sort_no_more_than_a_page(spark):
    from pyspark.sql import functions as F

    df = spark.range(1000).select(F.col("id").alias("external_fact_key"), (F.col("id") % 7).alias("price"))
    got = search._keyset_page(df, "price_desc", "external_fact_key", (3, 500), 5)
    assert [(r.price, r.external_fact_key) for r in got.items] == [(3, 507 + 7 * k) for k in range(5)] and got.total == 1000
    plan = df.filter(search._behind("price_desc", "external_fact_key", (3, 500))).orderBy("price").limit(6)
    assert "TakeOrderedAndProject" in plan._jdf.queryExecution().executedPlan().toString()
