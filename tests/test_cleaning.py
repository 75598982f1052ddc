"""Dirty rows the test tables do not have."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyshelf import schemas as S
from tallyshelf.functions import columns as C
from tallyshelf.operators import dedupe, gates, joins, keys
from tallyshelf.operators import standardize as Z
from tallyshelf.operators.adapters import amazon_historical_adapter, hybrid_csv_adapter


def raw(spark, *rows):
    names = ["platform", "external_product_id", "product_name", "price", "rating", "review_count", "collected_at"]
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def test_standardize_cleans_every_kind_of_cell(spark):
    df = Z.standardize(raw(
        spark,
        (" EBAY ", " 1 ", " name ", "abc", "5.1", "-1", "2026-10-11 09:00:00"),
        ("", "2", "n", "-1", "5", "7", "not a time"),
        (None, None, "n", "12.5", "0", "x", None),
    ), "etsy")
    assert df.columns == S.STANDARD_COLUMNS
    a, b, c = df.collect()
    assert (a.platform, a.external_product_id, a.product_name) == ("ebay", "1", "name")
    assert (a.price, a.rating, a.review_count, a.seller_name) == (None, None, None, None)
    assert a.observation_date == date(2026, 10, 11)
    assert (b.platform, b.price, b.rating, b.review_count, b.observation_date) == ("etsy", None, 5.0, 7, None)
    assert (c.platform, c.price, c.review_count) == ("etsy", 12.5, None)


def test_valid_core_needs_id_name_and_day(spark):
    df = Z.standardize(raw(
        spark, ("e", "1", "n", None, None, None, "2026-10-11"), ("e", " ", "n", None, None, None, "2026-10-11"),
        ("e", "2", "  ", None, None, None, "2026-10-11"), ("e", "3", "n", None, None, None, "x"),
        ("e", None, "n", None, None, None, "2026-10-11"),
    ), "e")
    assert [r.external_product_id for r in Z.filter_valid_core(df).collect()] == ["1"]


def scalar_cases():
    return [
        (C.parse_currency_price(F.lit("now ฿ 12,345.00")), 12345.0),
        (C.parse_currency_price(F.lit("฿1 or ฿2")), None),
        (C.parse_currency_price(F.lit("free")), None),
        (C.parse_price_text(F.lit(" 12.5 ")), 12.5),
        (C.parse_price_text(F.lit("$12.5")), None),
        (C.bound_price(F.lit(1e20)), None),
        (C.bound_price(F.lit(1.23456)), 1.2346),
        (C.null_tokens(F.lit(" N/A ")), None),
        (C.category_from_array(F.array().cast("array<string>"), F.lit("m")), "m"),
        (C.strip_nul(F.lit("a\u0000b")), "ab"),
        (C.blank_to_default(F.lit("  ")), "Uncategorized"),
        (C.epoch_to_timestamp(F.lit("soon")), None),
        (C.epoch_to_timestamp(F.lit(1_760_000_000_000_000)), None),
        (C.epoch_to_timestamp(F.lit("99999999999999999999")), None),
        (C.epoch_to_timestamp(F.lit(-(10**15))), None),
        (C.epoch_to_timestamp(F.lit(-1)), datetime(1969, 12, 31, 23, 59, 59)),
        (C.null_negative(F.lit(float("nan"))), None),
        (C.null_negative(F.lit(float("inf"))), None),
        (C.null_negative(F.lit(float("-inf"))), None),
        (C.null_negative(F.lit(0)), 0),
        (C.to_utc_naive(F.lit("2026-10-12T07:00:00+07:00")), datetime(2026, 10, 12)),
        (C.parse_timestamp_pattern(F.lit("2026-10-12 01:02:03.004")), datetime(2026, 10, 12, 1, 2, 3, 4000)),
        (C.fallback_product_name(F.lit(" \t"), F.lit("9"), "Etsy"), "Etsy product 9"),
        (C.price_band(F.lit(None).cast("double")), "Missing price"),
        (C.price_band(F.lit(49.99)), "25-49.99"),
        (C.price_band(F.lit(500.0)), "500+"),
        (C.iso_weekday(F.lit("2026-10-11").cast("date")), 7),
        (C.sunday_zero_weekday(F.lit("2026-10-11").cast("date")), 0),
        (C.date_key(F.lit("2026-10-11").cast("date")), 20261011),
    ]


def test_scalars(spark):
    cases = scalar_cases()
    row = spark.range(1).select(*[column.alias(f"c{i}") for i, (column, _) in enumerate(cases)]).first()
    assert list(row) == [expected for _, expected in cases]


def test_money_needs_a_positive_divisor(spark):
    df = spark.sql("SELECT named_struct('amount', a, 'divisor', d, 'currency_code', 'USD') AS p FROM VALUES "
                   "('1250', '100'), ('1250', '0'), ('x', '100'), (NULL, '1') AS t(a, d)")
    assert [r[0] for r in df.select(C.money_struct_to_price(F.col("p"))).collect()] == [12.5, None, None, None]


def test_daily_pick_is_newest_then_stable(spark):
    rows = [("e", "1", "b", "2", None, None, "2026-10-11 08:00:00"), ("e", "1", "a", "1", None, None, "2026-10-11 09:00:00"),
            ("e", "1", "c", "3", None, None, "2026-10-11 09:00:00"), ("e", "1", "d", "4", None, None, "2026-10-12 09:00:00")]
    for order in (rows, rows[::-1]):
        kept = dedupe.dedupe_daily_snapshot(Z.standardize(raw(spark, *order), "e")).orderBy("observation_date").collect()
        assert [r.product_name for r in kept] == ["a", "d"]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select(
        F.concat(F.lit("e"), F.col("id") % 1).alias("platform"), (F.col("id") % 1).cast("string").alias("external_product_id"),
        F.date_from_unix_date((F.col("id") % 1).cast("int")).alias("observation_date"),
        F.timestamp_seconds("id").alias("collected_at"),
    )
    kept = dedupe.dedupe_daily_snapshot(df)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert kept.count() == 1


def test_surrogate_keys_are_dense_and_repeatable(spark):
    ids = spark.range(5000).select(F.concat(F.lit("p"), "id").alias("k"))
    numbered = keys.assign_surrogate_keys(ids, ["k"], "key", 100)
    first = {r.k: r.key for r in numbered.collect()}
    again = {r.k: r.key for r in keys.assign_surrogate_keys(ids.repartition(7), ["k"], "key", 100).collect()}
    assert first == again
    assert sorted(first.values()) == list(range(101, 5101))
    start = spark.createDataFrame([(7,)], "max_key bigint")
    assert keys.assign_surrogate_keys(ids, ["k"], "key", start).agg(F.min("key")).first()[0] == 8


def test_strict_union_rejects_other_types(spark):
    with pytest.raises(ValueError):
        Z.union_strict([spark.range(1), spark.range(1).select(F.col("id").cast("string"))])


def test_price_snapshot_reports_every_reason(spark):
    columns = ("snapshot string, source_system string, external_product_id string, product_name string, price double, "
               "currency string, source_page string, observed_at_utc string, price_list_last_update string")
    good = ("s", "advice_th", "A1", "n", 10.5, "THB", "https://www.advice.co.th/x", "2026-10-12T00:00:00Z", "2026-07-22 10:30")
    rows = [good, good[:2] + ("A2",) + good[3:4] + (-1.005,) + good[5:], good[:2] + ("B9",) + good[3:],
            good[:2] + ("A2", " ", None, "USD", "http://x/", "later", "")]
    found = {(r.external_product_id, r.reason) for r in gates.validate_price_snapshot(spark.createDataFrame(rows, columns)).collect()}
    assert ("A1", "duplicate_id") not in found
    assert {("A2", "nonpositive_price"), ("A2", "too_many_decimals"), ("B9", "invalid_id"), ("A2", "duplicate_id"),
            ("A2", "blank_name"), ("A2", "wrong_currency"), ("A2", "wrong_page"), ("A2", "bad_observed_at"),
            ("A2", "bad_list_update"), (None, "mixed_observation_times")} <= found


def test_gates(spark):
    df = spark.range(20)
    assert gates.gate_row_count(df, exact=20) == gates.gate_row_count(df, minimum=1) == 20
    for bad in ({"exact": 19}, {"minimum": 21}):
        with pytest.raises(gates.GateError):
            gates.gate_row_count(df, **bad)
    with pytest.raises(gates.GateError):
        gates.check_required_columns(df, ["id", "name"])
    with pytest.raises(gates.GateError):
        gates.reject_unexpected_platform(df.withColumn("platform", F.lit("x")), "etsy")


def test_unknown_currency_stays_unconverted(spark):
    items = spark.createDataFrame([("USD", 2.0), ("THB", 5.0), ("XXX", 1.0), (None, 1.0)], "currency string, price double")
    rates = spark.createDataFrame([("USD", "THB", Decimal("33.579"), date(2026, 10, 11))],
                                  "base string, target string, rate decimal(18,6), rate_date date")
    found = {r.currency: r.price_converted for r in joins.convert_currency(items, rates).collect()}
    assert found == {"USD": Decimal("67.158"), "THB": Decimal("5"), "XXX": None, None: None}


def test_catalog_adapter(spark):
    rows = [(" B1 ", "short", "main", ["c"], "12.5", 4.0, 3, "s"), ("B1", "longer title", "main", [], "$9", 5.1, -1, None),
            ("", "t", None, None, None, None, None, None), ("B2", " ", None, None, None, None, None, None)]
    out = amazon_historical_adapter(spark.createDataFrame(rows, S.CATALOG_JSON)).collect()
    assert len(out) == 1
    assert (out[0].product_name, out[0].category, out[0].price, out[0].rating) == ("longer title", "main", None, None)
    assert out[0].collected_at is None and out[0].observation_date == date(2023, 9, 30)


def test_csv_adapter_maps_columns(spark):
    rows = [("1", "null", "9.5", "2023-01-02 03:04:05.678"), ("2", "name", "-3", "2023-01-02 03:04:05.678"), ("3", "n", "1", "bad")]
    df = spark.createDataFrame(rows, "product_id string, product_name string, final_price string, timestamp string")
    out = hybrid_csv_adapter(df, "walmart_csv").collect()
    assert [(r.external_product_id, r.price, r.currency) for r in out] == [("2", None, "USD")]
