"""Loads: idempotent, all-or-nothing, both fact policies."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyshelf import schemas as S
from tallyshelf.operators import aggregates as A
from tallyshelf.operators import gates, joins
from tallyshelf.plans import warehouse as W


def products(spark, *rows):
    full = [tuple(r.get(c) for c in S.STANDARD_COLUMNS) for r in rows]
    types = {**S.RAW_FIELDS, "observation_date": "date"}
    return spark.createDataFrame(full, ", ".join(f"{c} {types[c]}" for c in S.STANDARD_COLUMNS))


def snap(platform, pid, day, price=1.0, **more):
    base = {"platform": platform, "external_product_id": pid, "product_name": f"n{pid}", "price": price, "currency": "USD"}
    return {**base, "observation_date": date(2026, 10, day), "collected_at": datetime(2026, 10, day, 8), **more}


@pytest.fixture
def wh(spark, tmp_path):
    return W.Warehouse(spark, str(tmp_path / "wh"))


def test_reload_adds_nothing_and_new_rows_continue_the_keys(spark, wh):
    first = products(spark, snap("ebay", "1", 10), snap("ebay", "1", 11), snap("newmarket", "2", 10, None))
    assert W.load_fact_external(wh, first) == 3
    assert W.load_fact_external(wh, first) == 0
    again = first.unionByName(products(spark, snap("ebay", "1", 10, 99.0), snap("etsy", "3", 12)))
    assert W.load_fact_external(wh, again) == 1
    facts = wh.read("fact_external_product")
    assert sorted(r.external_fact_key for r in facts.collect()) == [1, 2, 3, 4]
    assert {float(r.price) for r in facts.filter("price IS NOT NULL").collect()} == {1.0}  # existing rows win
    assert wh.read("dim_platform").filter("platform_name = 'newmarket'").first().platform_key == 8
    assert wh.read("dim_product").count() == 3 and wh.read("dim_date").count() == 3
    assert A.duplicate_facts(facts).isEmpty() and A.duplicate_products(wh.read("dim_product")).isEmpty()
    quality = {r.platform_name: r.status for r in A.platform_quality(wh.frames()).collect()}
    assert quality["ebay"] == "PASS" and quality["newmarket"] == "WARNING" and quality["rakuten"] == "WARNING"


def test_upsert_policy_overwrites_only_its_columns(spark, wh):
    W.load_fact_external(wh, products(spark, snap("ebay", "1", 10, 5.0, rating=3.0), snap("ebay", "2", 10)))
    changed = products(spark, snap("ebay", "1", 10, 7.0, rating=1.0, currency="EUR"), snap("ebay", "9", 11))
    assert W.upsert_fact_external(wh, changed) == 1
    assert wh.read("fact_external_product").count() == 3
    row = wh.read("fact_external_product").filter("price = 7").first()
    assert (row.currency, float(row.rating)) == ("EUR", 3.0)


def test_failed_load_publishes_nothing(spark, wh):
    with pytest.raises(RuntimeError):
        with wh.publish() as load:
            W.load_platforms(load)
            raise RuntimeError("stop")
    assert wh.head()["version"] == 0 and wh.read("dim_platform").isEmpty()


def files(wh, table):
    from pathlib import Path

    return {str(p.relative_to(wh.root)) for p in Path(wh.root, table).rglob("*.parquet")}


def test_upsert_rewrites_its_parts_only(spark, wh):
    from pathlib import Path

    goods = lambda ids, name: spark.createDataFrame(
        [("internal", str(i), f"{name}{i}", "c", "b", None) for i in ids],
        "source_system string, source_product_id string, product_name string, category string, brand string, sku string")
    with wh.publish() as load:
        W.upsert_dim_product(load, goods(range(300), "old"))
    before = files(wh, "dim_product")
    assert len({f.split("/")[1] for f in before}) == W.PARTS
    ids = [7, 8, 9, 1000]
    with wh.publish() as load:
        W.upsert_dim_product(load, goods(ids, "new"))
    part = {r[0]: r[1] for r in goods(ids, "new").select("source_product_id", W.part_of("source_system", "source_product_id")).collect()}
    touched = {f"_part={p}" for p in part.values()}
    assert {f.split("/")[1] for f in before ^ files(wh, "dim_product")} == touched and len(touched) <= 4
    rows = {r.source_product_id: (r.product_key, r.product_name, r.updated_at is not None) for r in wh.read("dim_product").collect()}
    assert len(rows) == 301 and sorted(k for k, *_ in rows.values()) == list(range(1, 302))
    assert all(rows[str(i)][1:] == ((f"new{i}", True) if i in ids else (f"old{i}", False)) for i in range(300))
    assert not list(Path(wh.root, "scratch").glob("*"))


def test_emptied_month_goes(spark, wh):
    W.load_internal(wh, *shop(spark))
    assert {f.split("/")[1] for f in files(wh, "fact_sales")} == {"_part=202610"}
    W.load_internal(wh, *shop(spark, "2026-11-02 09:00:00"))
    assert {f.split("/")[1] for f in files(wh, "fact_sales")} == {"_part=202611"}


def test_moved_sales_are_found_by_key(spark, wh):
    """The months side table is read in the batch's parts only, the history in the touched months only."""
    W.load_internal(wh, *shop(spark))
    with wh.publish() as load:
        assert W.upsert_fact_sales(load, *shop(spark, "2026-12-01 10:00:00")[2:]) == 1
        (_, rows, months, *_), = load.last
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert months == [202610, 202612] and "PartitionFilters: [isnotnull(_part" in plan or "_part#" in plan
        load.last.clear()
        load.staged.clear()
        load.changed = False
    assert [r.date_key for r in wh.read("fact_sales").collect()] == [20261010]


def test_batch_is_shuffled_once_before_the_lookups(spark, wh):
    day = products(spark, *[snap("ebay", str(n), 10) for n in range(50)])
    with wh.publish() as load:
        rows = load.bucketed(day, ["platform", "external_product_id"])
        picked = W.dedupe.dedupe_snapshots(joins.fact_measures(rows, S.SNAPSHOT_KEY))
        plan = picked._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and picked.count() == 50
        names = rows.groupBy("platform", "external_product_id").count()
        assert "Exchange" not in names._jdf.queryExecution().executedPlan().toString()


def test_cut_off_load_hands_out_no_key_twice(spark, wh, monkeypatch):
    W.load_fact_external(wh, products(spark, snap("ebay", "1", 10)))
    log = W.Warehouse.log
    monkeypatch.setattr(W.Warehouse, "log", lambda self, v, done, *more: log(self, v, done, *more) if not done else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        W.load_fact_external(wh, products(spark, snap("ebay", "2", 10)))
    monkeypatch.undo()
    both = products(spark, snap("ebay", "2", 10), snap("ebay", "3", 10))
    assert W.load_fact_external(wh, both) == 1
    assert sorted(r[0] for r in wh.read("fact_external_product", ["external_fact_key"]).collect()) == [1, 2, 3]
    assert sorted(r[0] for r in wh.read("dim_product", ["product_key"]).collect()) == [1, 2, 3]


def test_upsert_refreshes_names(spark, wh):
    first = products(spark, snap("ebay", "1", 10), snap("etsy", "2", 10))
    W.load_fact_external(wh, first)
    W.load_fact_external(wh, first.withColumn("product_name", F.lit("new")))
    assert "new" not in {r.product_name for r in wh.read("dim_product").collect()}
    W.upsert_fact_external(wh, first.filter("platform = 'etsy'").withColumn("product_name", F.lit("new")))
    names = {r.source_product_id: (r.product_name, r.updated_at is not None, r.product_key) for r in wh.read("dim_product").collect()}
    assert names["2"][:2] == ("new", True) and names["1"][:2] != ("new", True)
    assert sorted(k for _, _, k in names.values()) == [1, 2]


def test_second_of_two_concurrent_loads_fails(spark, wh):
    with pytest.raises(Exception, match="another load"):
        with wh.publish() as outer:
            W.load_platforms(outer)
            with wh.publish() as inner:
                W.load_platforms(inner)
    assert wh.read("dim_platform").count() == 7


def shop(spark, order_date="2026-10-10 09:00:00", qty=2):
    items = spark.createDataFrame(
        [(1, 1, 10, qty, "5.00", "0.50", "9.00"), (2, 1, 10, 9, "5.00", "0.00", "45.00"), (3, 1, 77, 1, "1.00", "0.00", "1.00")],
        "order_item_id bigint, order_id bigint, product_id bigint, quantity int, unit_price string, discount_amount string, line_total string")
    orders = spark.createDataFrame(
        [(1, "O1", 500, order_date, "card", "web", "done", "0")],
        "order_id bigint, order_number string, customer_id bigint, order_date string, payment_method string, "
        "sales_channel string, order_status string, total_amount string").withColumn("order_date", F.col("order_date").cast("timestamp"))
    goods = spark.createDataFrame([(10, "S", "thing", "c", "b")],
                                  "product_id bigint, sku string, product_name string, category string, brand string")
    people = spark.createDataFrame([(400, "C", "F", 30, "p", "r", None)],
                                   "customer_id bigint, customer_code string, gender string, age int, province string, "
                                   "region string, registered_at timestamp")
    return goods, people, orders, items


def test_sales_skip_missing_products_and_keep_missing_customers(spark, wh):
    assert W.load_internal(wh, *shop(spark)) == 1
    sales = wh.read("fact_sales").collect()
    assert [(r.sales_key, r.quantity, r.customer_key, r.platform_key) for r in sales] == [(1, 9, None, 1)]


def test_corrected_order_date_moves_the_sale(spark, wh):
    W.load_internal(wh, *shop(spark))
    W.load_internal(wh, *shop(spark, "2026-11-02 09:00:00"))
    sales = wh.read("fact_sales").collect()
    assert [(r.sales_key, r.date_key) for r in sales] == [(1, 20261102)]
    assert wh.read("dim_product").count() == 1


@pytest.mark.parametrize("rows, expected", [
    ([], "iso"),
    ([("2026-10-11", 7), ("2026-10-12", 1)], "iso"),
    ([("2026-10-11", 0), ("2026-10-12", 1)], "sunday0"),
    ([("2026-10-11", 0), ("2026-10-18", 7)], None),
    ([("2026-10-12", 5)], None),
])
def test_weekday_style(spark, rows, expected):
    df = spark.createDataFrame(rows, "d string, day_of_week int").select(
        F.col("d").cast("date").alias("full_date"), F.date_format(F.col("d").cast("date"), "yyyyMMdd").cast("int").alias("date_key"),
        "day_of_week")
    if expected:
        assert W.detect_weekday_style(df) == expected
    else:
        with pytest.raises(gates.GateError):
            W.detect_weekday_style(df)


def test_catalog_goes_to_the_dimension_only(spark, wh):
    rows = [("B1", "long title", "", "b"), ("B1", "t", "c", "b"), ("x" * 256, "t", "c", "b"), ("B2", "", "c", "b")]
    catalog = spark.createDataFrame(rows, "source_product_id string, product_name string, category string, brand string")
    assert W.load_catalog_dim(wh, catalog) == 1 and W.load_catalog_dim(wh, catalog) == 0
    row = wh.read("dim_product").first()
    assert (row.product_name, row.category) == ("long title", None)
    assert wh.read("fact_external_product").isEmpty()


def test_months_outside_the_batch_are_not_read(spark, wh):
    W.load_fact_external(wh, products(spark, snap("ebay", "1", 10)))
    assert wh.read("fact_external_product", months=[202610]).count() == 1
    assert wh.read("fact_external_product", months=[202611]).isEmpty()


def test_orphans_and_constraints(spark):
    fact = spark.createDataFrame([(1, 1), (2, 9)], "product_key int, date_key int")
    dims = {"product_key": spark.createDataFrame([(1,)], "product_key int"), "date_key": spark.createDataFrame([(1,), (9,)], "date_key int")}
    assert {r.foreign_key: r.orphans for r in joins.fk_orphans(fact, dims).collect()} == {"product_key": 1, "date_key": 0}


def test_shuffles_are_sized_by_the_input(spark, tmp_path):
    # Partitions follow the size of the input, whatever the session's fixed number says.
    from tallyshelf import session

    kept = spark.conf.get(session._INITIAL, None)
    try:
        for n in (1, 9):
            folder = tmp_path / f"t{n}"
            folder.mkdir()
            (folder / "part").write_bytes(bytes(n * session.INPUT_A_PARTITION))
            session.size_shuffles(spark, str(folder))
            assert session.partitions(spark) == max(int(spark.conf.get("spark.sql.shuffle.partitions")), n)
    finally:
        spark.conf.unset(session._INITIAL) if kept is None else spark.conf.set(session._INITIAL, kept)


def test_first_load_shuffles_nothing_for_missing_tables(spark, tmp_path):
    from tallyshelf.operators import joins
    from tallyshelf.plans.warehouse import Warehouse

    rows = spark.range(5).selectExpr("cast(id AS int) AS date_key", "id AS product_key", "cast(id AS int) AS platform_key")
    new = joins.new_facts(rows, Warehouse(spark, str(tmp_path / "none")).read("fact_external_product"))
    assert "Join" not in new._jdf.queryExecution().optimizedPlan().toString() and new.count() == 5


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("splits", [1, 3])
def test_facts_are_numbered_where_their_month_is_written(spark, splits):
    from tallyshelf.operators.keys import assign_keys_by_part, assign_surrogate_keys

    rows = spark.range(700).selectExpr(
        "cast(20260100 + 100 * (id % 5) + id % 28 AS int) AS date_key", "id AS product_key", "1 AS platform_key", "'x' AS seller_name")
    want = assign_surrogate_keys(rows, S.FACT_KEY, "k", 40, 1)
    got = assign_keys_by_part(rows, S.FACT_KEY, "k", W.month_of(), splits, 40, 1)
    # Only narrow counts go by bucket; before, the wide rows went by bucket and again by month.
    plan = got._jdf.queryExecution().executedPlan().toString().split("\n")
    assert [line.count("hashpartitioning(_of") for line in plan if "Exchange" in line].count(1) == 1
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
    place = {}
    for r in got.withColumn("task", F.spark_partition_id()).collect():
        place.setdefault(r.date_key // 100, set()).add(r.task)
    assert all(len(tasks) <= splits for tasks in place.values())


def test_batch_in_buckets_is_used_as_it_lies(spark, wh, tmp_path):
    day = products(spark, *[snap("ebay", str(n), 10 + n % 3, float(n)) for n in range(40)], snap("ebay", "1", 11, 5.0, rating=2.0))
    table = W.in_buckets(day, W.BATCH_KEY, "day_in_buckets", str(tmp_path / "day"), W.dedupe.dedupe_daily_snapshot)
    assert exchanges(table.groupBy(*W.BATCH_KEY).count()) == 0 and table.count() == 40
    written = []
    bucketed = W.Load.bucketed
    try:
        W.Load.bucketed = lambda self, *a: written.append(a) or bucketed(self, *a)
        assert W.load_fact_external(wh, table, dealt=True) == 40 and not written
    finally:
        W.Load.bucketed = bucketed
    other = W.Warehouse(spark, str(tmp_path / "other"))
    assert W.load_fact_external(other, day) == 40
    columns = [f.name for f in S.FACT_EXTERNAL if f.name not in ("processed_at", "loaded_at")]
    assert sorted(map(str, wh.read("fact_external_product", columns).collect())) == sorted(
        map(str, other.read("fact_external_product", columns).collect()))
    spark.sql("DROP TABLE day_in_buckets")


def test_sales_keys_are_looked_up_before_orders_meet_items(spark, wh):
    W.load_internal(wh, *shop(spark))
    _, _, orders, items = shop(spark)
    dims = [wh.read(t) for t in ("dim_product", "dim_customer", "dim_platform")]
    plain = joins.sales_key_lookup(joins.sales_line_join(orders, items), *dims)
    keyed = joins.keyed_sales_lines(orders, items, *dims)
    assert keyed.columns == plain.columns and sorted(map(str, keyed.collect())) == sorted(map(str, plain.collect()))
    # With nothing small enough to broadcast, whole lines go by neither dimension nor key.
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        want, got = (exchanges(W.dedupe.dedupe_sales(f)) for f in (
            joins.sales_key_lookup(joins.sales_line_join(orders, items), *dims), joins.keyed_sales_lines(orders, items, *dims)))
        assert got == want - 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_sales_are_numbered_where_they_are_written(spark):
    from tallyshelf.operators.keys import assign_keys_where_dealt, assign_surrogate_keys

    # Days that do not rise with the key, a row without a day, a null in the key.
    rows = spark.range(600).selectExpr(
        "nullif(id, 7) AS order_id", "id % 3 AS product_key", "cast(nullif(20260100 + 100 * (id * 7 % 5) + id % 28, 20260120) AS int) AS date_key",
        "'x' AS order_status")
    want = assign_surrogate_keys(rows, S.SALES_KEY, "k", 40, 1)
    got = assign_keys_where_dealt(rows, S.SALES_KEY, "k", W.month_of(), F.when(W.month_of() == 202601, 3).otherwise(1), 40, 1)
    # Wide rows are dealt once, by month; keys alone go by bucket. Before, wide rows went by bucket and again by month.
    plan = got._jdf.queryExecution().executedPlan().toString().split("\n")
    assert sum("Exchange hashpartitioning(_of" in line for line in plan) == 1 and exchanges(got) == exchanges(want) + 1
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    place = {}
    for r in got.withColumn("task", F.spark_partition_id()).collect():
        place.setdefault(r.date_key and r.date_key // 100, set()).add(r.task)
    assert all(len(tasks) <= (3 if month == 202601 else 1) for month, tasks in place.items())


def test_first_sales_go_to_their_months_without_a_rebalance(spark, wh):
    dealt, at_last = [], W.Load.at_last
    try:
        W.Load.at_last = lambda self, *a, **k: dealt.append(k.get("dealt", False)) or at_last(self, *a, **k)
        W.load_internal(wh, *shop(spark))
        W.load_internal(wh, *shop(spark))
    finally:
        W.Load.at_last = at_last
    assert dealt == [True, False]


def test_skipped_lines_are_counted_as_lines_are_keyed(spark, wh, monkeypatch):
    goods, people, orders, items = shop(spark)
    odd = items.withColumn("product_id", F.lit(None).cast("bigint")).unionByName(items.withColumn("product_id", F.lit(987654321)))
    lines, counted = items.unionByName(odd), joins.sales_lines_skipped
    # Lines are not derived a second time to be counted, as they were before.
    monkeypatch.setattr(joins, "sales_lines_skipped", None)
    got = W.load_internal(wh, goods, people, orders, lines)
    assert got == counted(joins.sales_line_join(orders, lines), wh.read("dim_product")).first()[0] == 7
    assert wh.read("fact_sales").count() == 1


def test_counts_of_buckets_are_dealt_once(spark):
    from tallyshelf.operators.keys import assign_keys_by_part

    rows = spark.range(200).selectExpr("cast(20260101 + id % 28 AS int) AS date_key", "id AS product_key", "1 AS platform_key")
    got = assign_keys_by_part(rows, S.FACT_KEY, "k", W.month_of(), 1)
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert "ReusedExchange" in got.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)


def test_compared_items_are_taken_along(spark, monkeypatch):
    from types import SimpleNamespace

    from tallyshelf.plans import inputs as I

    tables = {
        "dim_platform": spark.createDataFrame([(1, "ebay")], "platform_key int, platform_name string"),
        "dim_product": spark.createDataFrame([(5, "ebay", "10", "thing")], "product_key bigint, source_system string, source_product_id string, product_name string"),
        "fact_external_product": spark.createDataFrame(
            [(100, 20261010, 5, 1, "USD", 2.0, None, 3), (101, 20261011, 5, 1, None, None, 1.0, None)],
            "external_fact_key bigint, date_key int, product_key bigint, platform_key int, currency string, price double, rating double, review_count bigint"),
    }
    # Order 1 names a fact twice, order 2 names both, order 3 a day without a fact, and one line names no order.
    lines = [(1, 10, 10), (1, 10, 10), (2, 10, 10), (2, 10, 11), (3, 10, 12), (None, 10, 11), (None, 10, 11)]
    lined = spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, d int").selectExpr(
        "l_orderkey", "l_partkey", "'ebay' AS source", "make_date(2026, 10, d) AS l_shipdate")
    monkeypatch.setattr(I, "star", lambda *a: SimpleNamespace(read=lambda t, columns: tables[t].select(*columns)))
    monkeypatch.setattr(I, "lines", lambda *a: lined)
    # Before, the requests were stored and each looked its fact, product and platform up again.
    monkeypatch.setattr(I, "_stored", None)
    got = I.request_items(spark, "x")
    assert got.columns == ["external_fact_key", "request_id", "currency", "price", "rating", "review_count", "product_name", "platform_name"]
    usd, bare = ("USD", 2.0, None, 3, "thing", "ebay"), (None, None, 1.0, None, "thing", "ebay")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [
        (100, 1, *usd), (100, 2, *usd), (101, 2, *bare), (101, None, *bare)]))
    assert I.derive_compare_requests(spark, "x").count() == 4


def test_whole_numbers_meet_product_ids_without_a_text(spark):
    ids = ["5", "05", "+5", " 5", "5.0", "x", None, "-7", "99999999999999999999"]
    dim = spark.createDataFrame([(S.INTERNAL_SOURCE, i, n) for n, i in enumerate(ids)] + [("ebay", "5", 50)],
                                "source_system string, source_product_id string, product_key bigint")
    for kind in ("bigint", "int", "string"):
        items = spark.createDataFrame([(5,), (-7,), (8,), (None,)], "n int").select(F.col("n").cast(kind).alias("product_id"), "n")
        got = joins._with_product(items, dim, "left")
        assert got.columns == ["product_id", "n", "product_key"]
        assert sorted(((r.n, r.product_key) for r in got.collect()), key=str) == [(-7, 7), (5, 0), (8, None), (None, None)]
    whole = joins._with_product(items.withColumn("product_id", F.col("n").cast("bigint")), dim)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        dealt = [line for line in whole.select("*")._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in line]
        # Before, the items' id was dealt a second time, as text.
        assert len(dealt) == 2 and "hashpartitioning(product_id#" in "".join(dealt)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_sales_are_staged_in_the_columns_of_their_table(spark, wh):
    staged, scratch = [], W.Load.scratch
    try:
        W.Load.scratch = lambda self, df: staged.append(df.columns) or scratch(self, df)
        W.load_internal(wh, *shop(spark))
    finally:
        W.Load.scratch = scratch
    # Before, ids and times that the table lacks were staged too.
    assert [f.name for f in S.FACT_SALES if f.name != "sales_key"] in staged and not any("order_item_id" in c for c in staged)
    assert wh.read("fact_sales").count() == 1


def test_lines_of_an_order_are_numbered_together(spark):
    from tallyshelf.operators.keys import assign_keys_where_dealt, assign_surrogate_keys

    rows = spark.range(600).selectExpr("id div 6 AS order_id", "id % 6 AS product_key", "20260101 AS date_key", "concat('ORD-', id div 6) AS order_number")
    got = assign_keys_where_dealt(rows, S.SALES_KEY, "k", W.month_of(), F.lit(4), 0, 1)
    # Before, pieces went by the whole key and the lines of an order came apart.
    tasks = got.withColumn("task", F.spark_partition_id()).groupBy("order_id").agg(F.countDistinct("task").alias("n"))
    assert tasks.filter("n > 1").isEmpty()
    assert sorted(got.collect()) == sorted(assign_surrogate_keys(rows, S.SALES_KEY, "k", 0, 1).collect())


def test_lines_are_dealt_before_their_texts_are_derived(spark):
    from tallyshelf.operators.standardize import filter_valid_core, product_key_cells, standardize
    from tallyshelf.plans import inputs as I

    lined = spark.range(400).selectExpr(
        "cast(nullif(id % 9, 8) AS int) AS l_linenumber", "nullif(id % 26, 25) AS l_partkey", "id % 7 AS l_suppkey", "id % 3 AS disc", "id % 50 + 100 AS cents",
        "cast(id % 5 + 1 AS double) AS l_quantity", "nullif(element_at(array('ebay', 'stockx'), cast(id % 2 AS int) + 1), 'x') AS source", "'R' AS l_returnflag",
        "nullif('anvil', if(id % 31 = 0, 'anvil', '')) AS p_name", "'T' AS p_type", "'b' AS p_brand", "cast(id % 51 AS int) AS p_size",
        "timestamp '2026-01-01' + make_interval(0, 0, 0, cast(id % 4 AS int)) AS l_shipdate").selectExpr(
        "*", "l_shipdate + make_interval(0, 0, 0, 0, l_linenumber) AS seen_at")
    raw = I._raw_cells(lined, F.expr(I._RAW_PLATFORM), F.expr(I._RAW_ID))
    want = W.dedupe.dedupe_daily_snapshot(filter_valid_core(standardize(raw, F.col("source"))))
    cells = product_key_cells(F.expr(I._RAW_PLATFORM), F.expr(I._RAW_ID), F.col("source"))
    got = I._daily_of_dealt(lined.withColumns(cells).repartition(3, *W.BATCH_KEY))
    assert got.schema.names == want.schema.names and sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and not got.isEmpty()
    # Before, urls, sellers and times were written out and dealt; the daily pick still needs no shuffle of its own.
    plan = got.select("*")._jdf.queryExecution().executedPlan().toString().split("\n")
    at = [n for n, line in enumerate(plan) if "Exchange" in line]
    assert len(at) == 1 and any("shop.example" in line for line in plan[:at[0]])
    assert not any("shop.example" in line for line in plan[at[0]:])
    # Lines of no product are left out before rows are dealt, so they don't meet in one task.
    assert any("Filter" in line and "trim" in line for line in plan[at[0]:])


def shuffle_files(spark):
    import os

    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in local for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}


def left_behind(spark, before):
    """Spark removes files in the background: a moment is given, and so are the shuffles of counts, one row of a few bytes a task."""
    import os
    import time

    for _ in range(20):
        found = [f for f in shuffle_files(spark) - before if f.endswith(".data")]
        if not found:
            break
        time.sleep(0.25)
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    sizes = {f: os.path.getsize(f"{d}/{f}") for top in local for d, _, names in os.walk(top) for f in names}
    return [f for f in found if sizes.get(f, 0) > 100]


def test_merged_equals_upsert(spark):
    cells = "k int, p int, sk bigint, price double, kept string"
    target = spark.createDataFrame([(1, 1, 10, 1.0, "a"), (1, 1, 11, 1.5, "twin"), (2, 1, 12, None, "b"), (None, 1, 13, 2.0, "n"), (3, None, 14, 3.0, "m")], cells)
    source = spark.createDataFrame([(1, 1, 9.0, "x"), (2, 1, None, "y"), (None, 1, 8.0, "z"), (4, 4, None, None), (5, 5, 7.0, "w")], "k int, p int, price double, kept string")
    got = W.merged(target, source, ["k", "p"], ["price"])
    assert got.columns == [*target.columns, "_is_new"]
    updated, new = W.upsert(target, source, ["k", "p"], ["price"])
    want = [(*r, False) for r in updated.collect()] + [(r.k, r.p, None, r.price, r.kept, True) for r in new.collect()]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want)) and len(want) == 8
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        # Before, the source was dealt a second time to find what is new, and the target's keys with it.
        assert got.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_stored_facts_are_merged_in_the_touched_months_only(spark, wh, monkeypatch):
    plans, merged = [], W.merged
    monkeypatch.setattr(W, "merged", lambda target, *a: plans.append(target._jdf.queryExecution().executedPlan().toString()) or merged(target, *a))
    for day in ("2026-10-10 10:00:00", "2026-12-01 10:00:00"):
        W.load_internal(wh, *shop(spark, day))
    W.load_fact_external(wh, products(spark, snap("ebay", "1", 10)))
    W.upsert_fact_external(wh, products(spark, snap("ebay", "1", 10), snap("ebay", "2", 10)))
    assert len(plans) == 2 and all("PartitionFilters: [isnotnull(_part" in p or "PartitionFilters: [_part#" in p for p in plans)
    assert [r.date_key for r in wh.read("fact_sales").collect()] == [20261201]
    assert sorted(r[0] for r in wh.read("fact_external_product", ["external_fact_key"]).collect()) == [1, 2]


def test_loads_leave_no_shuffles_behind(spark, wh):
    before, rows = shuffle_files(spark), spark.range(100).selectExpr("id", "id % 7 AS k").repartition(3, "k")
    with wh.publish() as load:
        # Before, the shuffles of every step stayed until the driver happened to collect its garbage.
        assert load.scratch(rows).count() == load.bucketed(rows, ["k"]).count() == 100 and W._values(rows, F.col("k")) == [*range(7)]
        load.append("dim_platform", rows.selectExpr("cast(id AS int) AS platform_key", "cast(k AS string) AS platform_name"))
    assert wh.read("dim_platform").count() == 100 and not left_behind(spark, before)


def test_daily_rows_are_written_where_they_lie(spark, tmp_path, monkeypatch):
    from tallyshelf.sources import writers

    rows = spark.range(60).selectExpr("element_at(array('ebay', 'etsy', null), cast(id % 3 AS int) + 1) AS platform", "cast(id % 7 AS string) AS external_product_id", "id")
    before = shuffle_files(spark)
    writers.write_partitioned_products(rows, f"{tmp_path}/a")
    assert not left_behind(spark, before)
    # Before, rows that the daily pick had just dealt were dealt once more.
    monkeypatch.setattr(type(rows), "repartition", None)
    writers.write_partitioned_products(rows, f"{tmp_path}/b", dealt=True)
    one, two = (sorted(map(str, spark.read.parquet(f"{tmp_path}/{x}").collect())) for x in "ab")
    assert one == two and len(one) == 60


def test_ranked_items_are_dealt_once(spark):
    from tallyshelf.operators import recommend as R

    cells = "request_id bigint, external_fact_key bigint, currency string, price double, rating double, review_count bigint"
    items = spark.createDataFrame([
        (1, 1, "USD", 10.0, 5.0, 1000), (1, 2, "USD", 20.0, None, None), (2, 1, "USD", 10.0, 5.0, 1000), (2, 3, "JPY", 1.0, 1.0, 1),
        (3, 4, "USD", None, 1.0, 1), (None, 1, "USD", 10.0, 5.0, 1000)], cells)
    got = R.recommend_products(items.repartition(3, "request_id"), "price")
    assert sorted((r.request_id, r.external_fact_key, r.score, r["rank"], r.limitation) for r in got.collect()) == [
        (1, 1, 1.1, 1, None), (1, 2, 0.0, 2, None), (2, 1, None, None, "several currencies"), (2, 3, None, None, "several currencies"),
        (3, 4, None, None, "missing price or currency")]
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        # Before, items were made twice, for the summary and for the scores, and dealt for each.
        assert got.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
