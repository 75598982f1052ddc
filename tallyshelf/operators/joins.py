"""Dimension lookups, anti-joins and the joins behind the read models.

Small dimensions carry no broadcast hint: they are stored tables whose size
Spark knows, so it broadcasts them below ``spark.sql.autoBroadcastJoinThreshold``
and shuffles them above it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import columns as C


# Rates that are sent to every task: there are fewer currencies than this.
MAX_CURRENCIES = 1000


def missing_from(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right.select(*keys), keys, "left_anti")


# --- what a load still has to add ------------------------------------------------


def new_platforms(products: DataFrame, dim_platform: DataFrame, platform_type: str = "marketplace") -> DataFrame:
    names = products.select(F.col("platform").alias("platform_name")).filter("platform_name IS NOT NULL").distinct()
    return missing_from(names, dim_platform, ["platform_name"]).withColumn("platform_type", F.lit(platform_type))


def product_rows(products: DataFrame) -> DataFrame:
    """Snapshots reduced to dimension rows, still with their collection time."""
    sku = F.col("sku") if "sku" in products.columns else F.lit(None).cast("string")
    return products.select(
        F.col("platform").alias("source_system"),
        F.col("external_product_id").alias("source_product_id"),
        "product_name", "category", "brand", sku.alias("sku"), "collected_at",
    )


def new_products(products: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Newest row of each product the dimension does not have.

    The anti-join runs first: in a daily load it removes almost everything, so
    the pick sees only products that are really new.
    """
    from .dedupe import dedupe_products

    unseen = missing_from(product_rows(products), dim_product, S.PRODUCT_KEY)
    return dedupe_products(unseen, S.PRODUCT_KEY)


def new_facts(facts: DataFrame, existing: DataFrame) -> DataFrame:
    return missing_from(facts, existing, S.FACT_KEY)


def missing_dates(days: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Distinct days (column ``full_date``) without a calendar row."""
    return missing_from(days.filter("full_date IS NOT NULL").distinct(), dim_date, ["full_date"])


def distinct_order_dates(orders: DataFrame) -> DataFrame:
    return orders.select(F.to_date("order_date").alias("full_date")).filter("full_date IS NOT NULL").distinct()


# --- fact key resolution ----------------------------------------------------------


def resolve_fact_keys(
    products: DataFrame, dim_platform: DataFrame, dim_product: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """Snapshots with their platform, product and date keys; a miss leaves the key NULL."""
    platforms = dim_platform.select(F.col("platform_name").alias("platform"), "platform_key")
    dates = dim_date.select(F.col("full_date").alias("observation_date"), "date_key")
    items = dim_product.select(
        F.col("source_system").alias("platform"),
        F.col("source_product_id").alias("external_product_id"),
        "product_key",
    )
    return (
        products.join(platforms, "platform", "left")
        .join(dates, "observation_date", "left")
        .join(items, ["platform", "external_product_id"], "left")
    )


def unresolved_facts(resolved: DataFrame) -> DataFrame:
    return resolved.filter("date_key IS NULL OR product_key IS NULL OR platform_key IS NULL")


def fact_measure_projection(resolved: DataFrame) -> DataFrame:
    """Warehouse types for the fact measures; a value that does not fit is NULL."""
    return fact_measures(resolved, S.FACT_KEY)


def fact_measures(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the fact measures in warehouse types."""
    types = {f.name: f.dataType.simpleString() for f in S.FACT_EXTERNAL}
    names = ["price", "original_price", "discount_percent", "rating", "review_count", "sold_count"]
    return rows.select(
        *keys, "currency",
        *[F.col(n).try_cast(types[n]).alias(n) for n in names],
        "seller_name", "product_url", F.col("collected_at").cast("timestamp").alias("collected_at"),
    )


# --- internal sales ---------------------------------------------------------------


_HEAD = ["order_number", "customer_id", "order_date", "payment_method", "sales_channel", "order_status"]
_ITEM = ["order_item_id", "product_id", "quantity", "unit_price", "discount_amount", "line_total"]


def sales_line_join(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Orders joined to their items, one row per item."""
    return orders.select("order_id", *_HEAD).join(order_items.select("order_id", *_ITEM), "order_id")


def _internal_products(dim_product: DataFrame) -> DataFrame:
    return dim_product.filter(F.col("source_system") == S.INTERNAL_SOURCE).select(
        F.col("source_product_id").alias("_pid"), "product_key"
    )


def _with_product(items: DataFrame, dim_product: DataFrame, how: str = "inner") -> DataFrame:
    """Items with the key of their product, whose text id in the dimension is ``product_id`` written out.

    A whole number meets the ids that are whole numbers written out, read back: items are then dealt by what they hold, without a text beside it.
    """
    products = _internal_products(dim_product)
    if not isinstance(items.schema["product_id"].dataType, T.IntegralType):
        return items.withColumn("_pid", F.col("product_id").cast("string")).join(products, "_pid", how).drop("_pid")
    number = F.col("_pid").try_cast("bigint")
    numbered = products.filter(number.cast("string") == F.col("_pid")).select(number.alias("_number"), "product_key")
    return items.join(numbered, F.col("product_id").cast("bigint") == F.col("_number"), how).drop("_number")


def _with_customer(orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    customers = dim_customer.select(F.col("source_customer_id").alias("customer_id"), "customer_key")
    return orders.join(customers, "customer_id", "left")


def _with_platform_and_day(lines: DataFrame, dim_platform: DataFrame) -> DataFrame:
    internal = dim_platform.filter(F.col("platform_name") == S.INTERNAL_SOURCE).select("platform_key")
    return lines.withColumn("platform_key", internal.scalar()).withColumn(
        "date_key", C.date_key(F.to_date("order_date")))


def sales_key_lookup(
    lines: DataFrame, dim_product: DataFrame, dim_customer: DataFrame, dim_platform: DataFrame
) -> DataFrame:
    """Sales lines with warehouse keys.

    A line without a product is left out (see ``sales_lines_skipped``); a line
    without a customer stays with a NULL customer key.
    """
    keyed = _with_customer(_with_product(lines, dim_product), dim_customer)
    return _with_platform_and_day(keyed, dim_platform)


def keyed_sales_lines(
    orders: DataFrame, order_items: DataFrame, dim_product: DataFrame, dim_customer: DataFrame, dim_platform: DataFrame,
    skipped: Observation | None = None,
) -> DataFrame:
    """``sales_key_lookup`` of ``sales_line_join``, with the keys looked up before the join.

    Customers meet orders and products meet items, so that dimensions too large
    to broadcast don't deal out whole lines, once for each of them. ``skipped``
    observes ``sales_lines_skipped`` in the same pass.
    """
    heads = _with_customer(orders.select("order_id", *_HEAD), dim_customer)
    items = _with_product(order_items.select("order_id", *_ITEM), dim_product, "inner" if skipped is None else "left")
    lines = heads.join(items, "order_id").select(
        "customer_id", "order_id", *[c for c in _HEAD if c != "customer_id"], *_ITEM, "product_key", "customer_key"
    )
    if skipped is not None:
        missing = F.count_if(F.col("product_key").isNull()).alias("skipped_lines")
        lines = lines.observe(skipped, missing).filter("product_key IS NOT NULL")
    return _with_platform_and_day(lines, dim_platform)


def sales_lines_skipped(lines: DataFrame, dim_product: DataFrame) -> DataFrame:
    keyed = lines.withColumn("_pid", F.col("product_id").cast("string"))
    missing = missing_from(keyed, _internal_products(dim_product), ["_pid"])
    return missing.agg(F.count("*").alias("skipped_lines"))


def line_and_order_totals(orders: DataFrame, order_items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items with ``line_total`` and orders with ``total_amount`` written back (0 without items)."""
    total = F.round((F.col("unit_price") - F.col("discount_amount")) * F.col("quantity"), 2)
    items = order_items.withColumn("line_total", total.cast("decimal(14,2)"))
    sums = items.groupBy("order_id").agg(F.sum("line_total").cast("decimal(14,2)").alias("_total"))
    written = orders.drop("total_amount").join(sums, "order_id", "left")
    total_amount = F.coalesce("_total", F.lit(0).cast("decimal(14,2)")).alias("total_amount")
    return items, written.select(*[c for c in written.columns if c != "_total"], total_amount)


# --- integrity and read models -----------------------------------------------------


def fk_orphans(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows per foreign key whose dimension row is missing, as (foreign_key, orphans)."""
    counts = [
        missing_from(fact.select(key).filter(F.col(key).isNotNull()), dim, [key])
        .agg(F.count("*").alias("orphans"))
        .select(F.lit(key).alias("foreign_key"), "orphans")
        for key, dim in dims.items()
    ]
    out = counts[0]
    for frame in counts[1:]:
        out = out.union(frame)
    return out


def marketplace_snapshot(wh: dict[str, DataFrame]) -> DataFrame:
    """Detail read model; currency stays in the grain so prices are never mixed."""
    platforms = wh["dim_platform"].filter(F.col("platform_type") != "internal").select(
        "platform_key", F.col("platform_name").alias("marketplace")
    )
    dates = wh["dim_date"].select("date_key", F.col("full_date").alias("observation_date"))
    products = wh["dim_product"].select("product_key", "source_product_id", "product_name", "category", "brand")
    return (
        wh["fact_external_product"].join(platforms, "platform_key").join(dates, "date_key").join(products, "product_key")
        .select(
            "marketplace", "observation_date", "currency", "source_product_id", "product_name", "category", "brand",
            "price", "original_price", "discount_percent", "rating", "review_count", "sold_count", "seller_name",
            "product_url", "collected_at", "processed_at", "loaded_at",
        )
    )


def compare_products(wh: dict[str, DataFrame], requests: DataFrame) -> DataFrame:
    """Product, platform and price of the facts each request names.

    ``requests`` holds (request_id, external_fact_key). Every request is kept,
    however many facts it names: ranking says which ones it refuses and why.
    """
    named = requests.distinct()
    facts = wh["fact_external_product"].select(
        "external_fact_key", "product_key", "platform_key", "currency", "price", "rating", "review_count",
        "product_url", "collected_at",
    )
    return (
        named.join(facts, "external_fact_key")
        .join(wh["dim_product"].select("product_key", "product_name"), "product_key")
        .join(wh["dim_platform"].select("platform_key", "platform_name"), "platform_key")
        .select(
            "request_id", "external_fact_key", "product_key", "product_name", "platform_name", "currency", "price",
            "rating", "review_count", "product_url", "collected_at",
        )
    )


def product_history(wh: dict[str, DataFrame], product_key: int | None = None) -> DataFrame:
    """Every product (or one) with all its facts; a product without facts keeps one row.

    One product's history comes newest first. The history of all products is
    left unordered: sorting it would move the whole fact table once more.
    """
    products = wh["dim_product"].select(
        "product_key", "source_product_id", "product_name", "category", "brand"
    )
    if product_key is not None:
        products = products.filter(F.col("product_key") == product_key)
    facts = wh["fact_external_product"].select(
        "product_key", "platform_key", "currency", "price", "rating", "review_count", "product_url", "collected_at",
        "external_fact_key",
    )
    history = (
        products.join(facts, "product_key", "left")
        .join(wh["dim_platform"].select("platform_key", "platform_name"), "platform_key", "left")
        .select(
            "product_key", "source_product_id", "product_name", "category", "brand", "platform_name", "currency",
            "price", "rating", "review_count", "product_url", "collected_at", "external_fact_key",
        )
    )
    if product_key is None:
        return history
    return history.orderBy(F.col("collected_at").desc_nulls_last(), F.col("external_fact_key").desc_nulls_last())


def convert_currency(items: DataFrame, rates: DataFrame, target: str = "THB") -> DataFrame:
    """Price in ``target``; an unknown currency leaves ``price_converted`` NULL.

    ``rates`` holds (base, target, rate decimal(18,6), rate_date); of several
    rows for a pair the newest counts. The target currency itself converts at
    rate 1. A handful of currencies hold all items, so items are not dealt out
    by currency: up to ``MAX_CURRENCIES`` rates, which is counted, are sent to
    every task. More of them meet items by a plain join.
    """
    newest = F.max(F.struct("rate_date", "rate")).alias("_r")
    pair = rates.filter((F.col("target") == target) & F.col("base").isNotNull()).groupBy(
        F.col("base").alias("currency")
    ).agg(newest).select("currency", F.col("_r.rate").alias("_rate"), F.col("_r.rate_date").alias("rate_date"))
    if pair.limit(MAX_CURRENCIES + 1).count() <= MAX_CURRENCIES:
        pair = F.broadcast(pair)
    rate = F.when(F.col("currency") == target, F.lit(1)).otherwise(F.col("_rate")).cast("decimal(18,6)")
    return (
        items.join(pair, "currency", "left")
        .withColumn("fx_rate", rate)
        .withColumn("price_converted", (F.col("price").cast("decimal(18,4)") * F.col("fx_rate")).cast("decimal(24,6)"))
        .drop("_rate")
        .withColumn("target_currency", F.lit(target))
    )
