"""Reports. Each is one aggregation over one scan; partial aggregation runs before every shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C

# Unique-product targets of the progress report.
PRODUCT_TARGETS = {"remaining_to_500k": 500_000, "remaining_to_1m": 1_000_000}


def _rows(name: str = "rows") -> Column:
    return F.count("*").alias(name)


def _how_many(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


# --- processed snapshots -----------------------------------------------------------


def platform_counts(products: DataFrame) -> DataFrame:
    return products.groupBy("platform").agg(_rows())


def platform_day_counts(products: DataFrame) -> DataFrame:
    return products.groupBy("platform", "observation_date").agg(_rows()).orderBy("platform", "observation_date")


def etl_quality_summary(valid: DataFrame) -> DataFrame:
    """Rows before and after the daily dedupe, priced rows and snapshot days, in one scan.

    Each snapshot key is reduced to its row count and to whether the row the
    dedupe keeps has a price, so the table is shuffled once and combined before
    the shuffle. The sort struct spells out the pick order of the dedupe:
    newest first, then all other columns with NULL last.
    """
    rest = [c for c in valid.columns if c not in S.SNAPSHOT_KEY and c != "collected_at"]
    newest_first = F.struct(
        F.col("collected_at").isNull(), -F.unix_micros("collected_at"),
        *[part for c in rest for part in (F.col(c).isNull(), F.col(c))],
    )
    kept = valid.groupBy(*S.SNAPSHOT_KEY).agg(
        _rows("_n"), F.min_by(F.col("price").isNotNull(), newest_first).alias("_priced")
    )
    return kept.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_before"),
        _rows("rows_after"),
        (F.coalesce(F.sum("_n"), F.lit(0)) - F.count("*")).alias("duplicates_removed"),
        _how_many(F.col("_priced"), "rows_with_price"),
        _how_many(~F.col("_priced"), "rows_missing_price"),
        F.countDistinct("observation_date").alias("snapshot_days"),
    )


def gold_marketplace_summary(silver: DataFrame) -> DataFrame:
    """Per source and currency, so averages never mix currencies."""
    return silver.groupBy("source_system", "currency").agg(
        _rows("total_rows"),
        F.countDistinct("product_id").alias("unique_products"),
        _how_many(F.col("price").isNotNull(), "products_with_price"),
        _how_many(F.col("price").isNull(), "products_missing_price"),
        F.round(F.avg("price"), 2).alias("average_price"),
    )


def silver_quality(silver: DataFrame) -> DataFrame:
    return silver.groupBy("source_system").agg(
        _rows("total_rows"),
        F.count("product_id").alias("valid_ids"),
        F.count("product_name").alias("valid_names"),
        F.count("price").alias("valid_prices"),
    )


def conflicting_prices(df: DataFrame, keys: list[str]) -> DataFrame:
    """Ids seen with more than one price inside one snapshot."""
    prices = df.groupBy(*keys).agg(
        F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        F.countDistinct("price").alias("distinct_prices"),
    )
    return prices.filter("distinct_prices > 1")


def union_with_total(groups: DataFrame, label: str, count: str, total_name: str) -> DataFrame:
    """Group rows plus their grand total."""
    total = groups.agg(F.coalesce(F.sum(count), F.lit(0)).alias(count)).select(F.lit(total_name).alias(label), count)
    return groups.select(label, count).unionByName(total)


# --- product dimension --------------------------------------------------------------


def _marketplace(dim_product: DataFrame) -> DataFrame:
    return dim_product.filter(F.col("source_system") != S.INTERNAL_SOURCE)


def products_by_source_with_total(dim_product: DataFrame) -> DataFrame:
    """Distinct products per source and their total, which is there even for an empty dimension."""
    counted = _marketplace(dim_product).groupBy("source_system").agg(_rows("unique_products"))
    return union_with_total(counted, "source_system", "unique_products", "TOTAL_MARKETPLACE").orderBy("source_system")


def products_by_load_day(dim_product: DataFrame) -> DataFrame:
    return (
        _marketplace(dim_product)
        .groupBy(F.to_date("created_at").alias("warehouse_load_date"), "source_system")
        .agg(_rows("new_unique_products"))
        .orderBy(F.col("warehouse_load_date").desc_nulls_last(), "source_system")
    )


def product_growth(dim_product: DataFrame) -> DataFrame:
    return _marketplace(dim_product).groupBy(
        F.to_date("created_at").alias("ingestion_date"), F.col("source_system").alias("marketplace")
    ).agg(_rows("new_unique_products"))


def duplicate_products(dim_product: DataFrame) -> DataFrame:
    """Identity duplicates; a sound dimension has none."""
    return _marketplace(dim_product).groupBy(*S.PRODUCT_KEY).agg(_rows("duplicate_count")).filter("duplicate_count > 1")


def missing_identity_counts(dim_product: DataFrame) -> DataFrame:
    return _marketplace(dim_product).groupBy("source_system").agg(
        _how_many(C.is_blank(F.col("source_product_id")), "missing_product_id"),
        _how_many(C.is_blank(F.col("product_name")), "missing_product_name"),
    ).orderBy("source_system")


def target_progress(dim_product: DataFrame) -> DataFrame:
    total = F.count("*")
    return _marketplace(dim_product).agg(
        total.alias("unique_marketplace_products"),
        *[(F.lit(target) - total).alias(name) for name, target in PRODUCT_TARGETS.items()],
    )


def products_by_marketplace(dim_product: DataFrame) -> DataFrame:
    return _marketplace(dim_product).groupBy(F.col("source_system").alias("marketplace")).agg(
        _rows("unique_products"),
        F.min("created_at").alias("first_loaded_at"),
        F.max("created_at").alias("latest_loaded_at"),
    )


def products_by_category(dim_product: DataFrame) -> DataFrame:
    return _marketplace(dim_product).groupBy(
        F.col("source_system").alias("marketplace"), C.blank_to_default(F.col("category")).alias("category")
    ).agg(_rows("unique_products"))


def catalog_data_quality(dim_product: DataFrame) -> DataFrame:
    return _marketplace(dim_product).groupBy(F.col("source_system").alias("marketplace")).agg(
        _rows("total_products"),
        _how_many(C.is_blank(F.col("source_product_id")), "missing_product_id"),
        _how_many(C.is_blank(F.col("product_name")), "missing_product_name"),
        (F.count("*") - F.countDistinct("source_product_id")).alias("duplicate_product_ids"),
    )


# --- facts ----------------------------------------------------------------------------


def _marketplace_platforms(dim_platform: DataFrame) -> DataFrame:
    return dim_platform.filter(F.col("platform_type") != "internal").select("platform_key", "platform_name")


def facts_by_source_day(wh: dict[str, DataFrame]) -> DataFrame:
    """Counted on the keys first, so the name lookups join a few rows."""
    counts = wh["fact_external_product"].groupBy("platform_key", "date_key").agg(_rows("warehouse_rows"))
    return (
        counts.join(_marketplace_platforms(wh["dim_platform"]), "platform_key")
        .join(wh["dim_date"].select("date_key", "full_date"), "date_key")
        .select(F.col("platform_name").alias("source_system"), F.col("full_date").alias("observation_date"),
                "warehouse_rows")
        .orderBy(F.col("observation_date").desc(), "source_system")
    )


def platform_quality(wh: dict[str, DataFrame]) -> DataFrame:
    """Integrity and readiness per marketplace; a platform without facts keeps its row.

    Facts are aggregated by platform key before the platform names come in, so
    a dominant platform is reduced map-side.
    """
    facts = wh["fact_external_product"].select(
        "external_fact_key", "platform_key", "product_key", "date_key", "price", "currency"
    )
    products = wh["dim_product"].select("product_key", F.lit(True).alias("_has_product"))
    dates = wh["dim_date"].select("date_key", "full_date", F.lit(True).alias("_has_date"))
    orphan = F.col("_has_product").isNull() | F.col("_has_date").isNull()
    measured = (
        facts.join(products, "product_key", "left").join(dates, "date_key", "left").groupBy("platform_key").agg(
            _rows("fact_rows"),
            F.countDistinct("product_key").alias("unique_products"),
            _how_many(F.col("date_key").isNull(), "null_date_keys"),
            _how_many(F.col("price").isNull(), "null_prices"),
            _how_many(F.col("price") < 0, "invalid_prices"),
            _how_many(C.is_blank(F.col("currency")), "missing_currency"),
            _how_many(orphan, "orphan_foreign_keys"),
            F.min("full_date").alias("min_observation_date"),
            F.max("full_date").alias("max_observation_date"),
        )
    )
    counts = [c for c in measured.columns if c != "platform_key" and not c.endswith("_date")]
    filled = _marketplace_platforms(wh["dim_platform"]).join(measured, "platform_key", "left").select(
        "platform_name",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts],
        "min_observation_date", "max_observation_date",
    )
    failed = (F.col("orphan_foreign_keys") > 0) | (F.col("null_date_keys") > 0) | (F.col("invalid_prices") > 0)
    incomplete = (F.col("fact_rows") == 0) | (F.col("null_prices") > 0) | (F.col("missing_currency") > 0)
    status = F.when(failed, "FAIL").when(incomplete, "WARNING").otherwise("PASS")
    return filled.withColumn("status", status).orderBy("platform_name")


def duplicate_facts(facts: DataFrame) -> DataFrame:
    return facts.groupBy(*S.FACT_KEY).agg(_rows("duplicate_count")).filter("duplicate_count > 1")


def price_distribution(wh: dict[str, DataFrame]) -> DataFrame:
    counts = wh["fact_external_product"].groupBy(
        "platform_key", "currency", C.price_band(F.col("price")).alias("price_band")
    ).agg(_rows("observations"))
    named = counts.join(_marketplace_platforms(wh["dim_platform"]), "platform_key")
    return named.select(F.col("platform_name").alias("marketplace"), "currency", "price_band", "observations")


def warehouse_summary(facts: DataFrame) -> DataFrame:
    return facts.agg(
        _rows("snapshot_records"),
        F.countDistinct("product_key").alias("searchable_products"),
        F.countDistinct("platform_key").alias("priced_platforms"),
        F.max("collected_at").alias("latest_collected_at"),
    )


def fact_totals_by_platform(wh: dict[str, DataFrame]) -> DataFrame:
    totals = wh["fact_external_product"].groupBy("platform_key").agg(
        _rows("snapshots"),
        F.countDistinct("product_key").alias("distinct_products"),
        F.min("collected_at").alias("first_collected_at"),
        F.max("collected_at").alias("last_collected_at"),
        _how_many(C.is_blank(F.col("currency")), "blank_currency_rows"),
    )
    return totals.join(_marketplace_platforms(wh["dim_platform"]), "platform_key").drop("platform_key")


def avg_price_per_currency(snapshot: DataFrame) -> DataFrame:
    """Read-model measures; the average is over priced rows of one currency only."""
    return snapshot.groupBy("currency").agg(
        _rows("snapshot_rows"),
        F.countDistinct("marketplace", "source_product_id").alias("products"),
        _how_many(F.col("price").isNotNull() & C.not_blank(F.col("currency")), "priced_snapshot_rows"),
        F.round(F.avg(F.col("price").cast("double")), 4).alias("average_price"),
    )


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [t.agg(_rows("rows")).select(F.lit(name).alias("table_name"), "rows") for name, t in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def before_after_load_counts(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    old = table_row_counts(before).withColumnRenamed("rows", "rows_before")
    new = table_row_counts(after).withColumnRenamed("rows", "rows_after")
    joined = new.join(old, "table_name", "left").withColumn("rows_before", F.coalesce("rows_before", F.lit(0)))
    return joined.withColumn("rows_added", F.col("rows_after") - F.col("rows_before"))


# --- catalog ----------------------------------------------------------------------------


def catalog_profile(datasets: dict[str, DataFrame]) -> DataFrame:
    """Rows and distinct ids per dataset, and which alias columns it has."""
    profiles = []
    for name, df in datasets.items():
        found = {target: next((c for c in names if c in df.columns), None) for target, names in S.CATALOG_ALIASES.items()}
        product_id = F.col(found["id"]).cast("string") if found["id"] else F.lit(None).cast("string")
        profiles.append(
            df.agg(
                _rows("rows"),
                F.countDistinct(F.when(C.not_blank(product_id), product_id)).alias("unique_product_ids"),
            ).select(
                F.lit(name).alias("dataset"), "rows", "unique_product_ids",
                *[F.lit(column).cast("string").alias(f"{target}_column") for target, column in found.items()],
                F.lit(bool(found["price"] and found["observation_date"])).alias("has_price_observation"),
            )
        )
    return reduce(DataFrame.unionByName, profiles)


def unique_catalog_products(datasets: list[DataFrame], column: str = "parent_asin") -> DataFrame:
    ids = reduce(DataFrame.unionByName, [df.select(column) for df in datasets])
    return ids.filter(C.not_blank(F.col(column))).agg(F.countDistinct(column).alias("unique_products"))


# --- compare view, run metrics and keyword progress ------------------------------------------


def group_items_by_currency(items: DataFrame) -> DataFrame:
    """Priced items of each comparison, listed per currency.

    A list is as long as the comparison names priced items of the currency.
    """
    item = F.struct("external_fact_key", "product_name", "platform_name", "price")
    return items.filter("price IS NOT NULL").groupBy("request_id", "currency").agg(
        F.array_sort(F.collect_list(item)).alias("items")
    )


def daily_request_metrics(metrics: DataFrame) -> DataFrame:
    """Request totals per UTC day plus the attempts of the day's last run."""
    order = F.struct("recorded_at", "run_id")
    return metrics.groupBy(F.to_date("recorded_at").alias("day")).agg(
        F.sum("http_attempts").alias("http_attempts"),
        F.sum("http_429").alias("http_429"),
        F.max_by("http_attempts", order).alias("latest_http_attempts"),
    )


def keyword_progress(plan: DataFrame, state: DataFrame) -> DataFrame:
    """Completed keywords and the rest of the plan."""
    done = state.filter(F.col("state") == "completed").select("keyword", F.lit(1).alias("_done"))
    return plan.join(done, "keyword", "left").agg(
        F.count("_done").alias("completed_keywords"),
        (F.count("*") - F.count("_done")).alias("pending_keywords"),
    )
