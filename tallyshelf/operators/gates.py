"""Row rules that report violations, and gates that stop a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


class GateError(RuntimeError):
    """A precondition of a job does not hold; nothing was written."""


def check_required_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise GateError(f"missing columns: {missing}")
    return df


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def gate_row_count(df: DataFrame, minimum: int | None = None, exact: int | None = None) -> int:
    """Row count of ``df``; raises unless it is at least ``minimum`` / exactly ``exact``."""
    n = df.count()
    if exact is not None and n != exact:
        raise GateError(f"expected {exact} rows, got {n}")
    if minimum is not None and n < minimum:
        raise GateError(f"expected at least {minimum} rows, got {n}")
    return n


def unexpected_platforms(df: DataFrame, platform: str) -> DataFrame:
    """Rows per platform other than the expected one."""
    wrong = df.filter(F.col("platform").isNull() | (F.col("platform") != platform))
    return wrong.groupBy("platform").agg(F.count("*").alias("rows"))


def reject_unexpected_platform(df: DataFrame, platform: str) -> DataFrame:
    found = unexpected_platforms(df, platform).agg(F.sum("rows")).first()[0]
    if found:
        raise GateError(f"{found} rows are not from {platform}")
    return df


def _explode_reasons(df: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    reasons = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))
    return df.select(*keys, F.explode(reasons).alias("reason"))


def validate_price_snapshot(
    df: DataFrame, source: str = "advice_th", currency: str = "THB",
    page_prefix: str = "https://www.advice.co.th/", max_price: str = "9999999999.99",
) -> DataFrame:
    """Every broken rule of a price-list batch as (snapshot, external_product_id, reason).

    ``snapshot`` identifies the batch. Repeated ids and mixed observation times
    are found by grouping, so one huge batch is pre-aggregated like any other.
    """
    pid = F.coalesce(C.strip_whitespace(F.col("external_product_id")), F.lit(""))
    rows = df.withColumn("external_product_id", pid)
    price = F.col("price")
    cents = price.try_cast("decimal(38,10)")

    def blank(name: str) -> Column:
        return F.coalesce(C.strip_whitespace(F.col(name)), F.lit("")) == ""

    def never_null(rule: Column) -> Column:
        return F.coalesce(rule, F.lit(True))

    rules = {
        "wrong_source": never_null(F.col("source_system") != source),
        "invalid_id": ~F.col("external_product_id").rlike("^A[0-9]+$"),
        "blank_name": blank("product_name"),
        "wrong_currency": never_null(F.col("currency") != currency),
        "nonpositive_price": never_null(price <= 0),
        "too_many_decimals": F.coalesce(cents != F.round(cents, 2), F.lit(False)),
        "price_too_large": F.coalesce(cents > F.lit(max_price).cast("decimal(38,10)"), F.lit(False)),
        "bad_observed_at": C.to_utc_naive(F.col("observed_at_utc")).isNull(),
        "bad_list_update": C.to_utc_naive(F.col("price_list_last_update")).isNull(),
        "wrong_page": never_null(~F.col("source_page").startswith(page_prefix)),
    }
    single = _explode_reasons(rows, ["snapshot", "external_product_id"], rules)
    repeated = (
        rows.groupBy("snapshot", "external_product_id").agg(F.count("*").alias("_n")).filter("_n > 1")
        .select("snapshot", "external_product_id", F.lit("duplicate_id").alias("reason"))
    )
    mixed = (
        rows.groupBy("snapshot")
        .agg(F.min("observed_at_utc").alias("_lo"), F.max("observed_at_utc").alias("_hi")).filter("_lo <> _hi")
        .select("snapshot", F.lit(None).cast("string").alias("external_product_id"),
                F.lit("mixed_observation_times").alias("reason"))
    )
    return single.unionByName(repeated).unionByName(mixed)


def check_constraints_internal(
    products: DataFrame, customers: DataFrame, orders: DataFrame, order_items: DataFrame
) -> DataFrame:
    """Violated table rules as (table_name, row_id, reason)."""

    def scan(df: DataFrame, table: str, key: str, rules: dict[str, Column]) -> DataFrame:
        rows = _explode_reasons(df, [key], rules)
        return rows.select(F.lit(table).alias("table_name"), F.col(key).cast("bigint").alias("row_id"), "reason")

    def dangling(df: DataFrame, table: str, key: str, parent: DataFrame, column: str) -> DataFrame:
        rows = df.select(key, column).join(parent.select(column), column, "left_anti")
        return rows.select(
            F.lit(table).alias("table_name"), F.col(key).cast("bigint").alias("row_id"),
            F.lit(f"missing_{column}").alias("reason"),
        )

    found = [
        scan(products, "products", "product_id", {
            "negative_cost": F.col("cost_price") < 0,
            "negative_price": F.col("selling_price") < 0,
            "negative_stock": F.col("stock_quantity") < 0,
        }),
        scan(customers, "customers", "customer_id", {"age_out_of_range": ~F.col("age").between(10, 120)}),
        scan(orders, "orders", "order_id", {"negative_total": F.col("total_amount") < 0}),
        scan(order_items, "order_items", "order_item_id", {
            "quantity_not_positive": F.col("quantity") <= 0,
            "negative_price": F.col("unit_price") < 0,
            "negative_discount": F.col("discount_amount") < 0,
            "negative_total": F.col("line_total") < 0,
        }),
        dangling(orders, "orders", "order_id", customers, "customer_id"),
        dangling(order_items, "order_items", "order_item_id", orders, "order_id"),
        dangling(order_items, "order_items", "order_item_id", products, "product_id"),
    ]
    out = found[0]
    for frame in found[1:]:
        out = out.unionByName(frame)
    return out
