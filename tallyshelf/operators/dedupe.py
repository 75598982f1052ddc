"""Pick-one-row operators.

All picks are deterministic: newest (or best) first, then every remaining
column. ``row_number() = 1`` lets Spark keep one row per key inside each map
task (``WindowGroupLimit``) before the shuffle, so a key that holds a large
share of the rows reaches its reducer as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S


def pick_first(df: DataFrame, keys: list[str], order: list[Column], ties: bool = True) -> DataFrame:
    """One row per key: first by ``order``, then by all other columns ascending."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys] if ties else []
    window = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_pick", F.row_number().over(window)).filter(F.col("_pick") == 1).drop("_pick")


def dedupe_daily_snapshot(df: DataFrame) -> DataFrame:
    """One row per platform, product and day: the newest one."""
    return pick_first(df, S.SNAPSHOT_KEY, [F.col("collected_at").desc_nulls_last()])


def dedupe_daily_keep_last(df: DataFrame) -> DataFrame:
    """One row per product and day of a single-source frame: the newest one."""
    return pick_first(df, ["external_product_id", "full_date"], [F.col("collected_at").desc_nulls_last()])


def dedupe_products(df: DataFrame, keys: list[str] | None = None, newest: str = "collected_at") -> DataFrame:
    """One row per product, from its newest snapshot."""
    return pick_first(df, keys or ["platform", "external_product_id"], [F.col(newest).desc_nulls_last()])


def latest_name_per_product(df: DataFrame) -> DataFrame:
    """Newest name per id; equal times go to the alphabetically last name."""
    newest = F.max_by("product_name", F.struct("collected_at", "product_name"))
    return df.groupBy("external_product_id").agg(newest.alias("product_name"))


def best_title_per_product(df: DataFrame) -> DataFrame:
    """Longest title per catalog id, then the alphabetically first."""
    order = [F.length("product_name").desc(), F.col("product_name").asc()]
    return pick_first(df, ["source_product_id"], order)


def latest_fact_per_product(facts: DataFrame) -> DataFrame:
    """Newest fact per product and platform; equal times go to the newer fact key."""
    order = [F.col("collected_at").desc_nulls_last(), F.col("external_fact_key").desc()]
    return pick_first(facts, ["product_key", "platform_key"], order, ties=False)


def dedupe_facts(facts: DataFrame) -> DataFrame:
    """One row per fact business key: the newest one."""
    return pick_first(facts, S.FACT_KEY, [F.col("collected_at").desc_nulls_last()])


def dedupe_snapshots(measures: DataFrame) -> DataFrame:
    """One row per product and day, the newest one: ``dedupe_facts`` before the keys are looked up."""
    return pick_first(measures, S.SNAPSHOT_KEY, [F.col("collected_at").desc_nulls_last()])


def dedupe_sales(sales: DataFrame) -> DataFrame:
    """One row per order and product: the largest line number, then the highest unit price."""
    order = [F.col("order_item_id").desc_nulls_last(), F.col("unit_price").desc_nulls_last()]
    return pick_first(sales, S.SALES_KEY, order)


def first_seen_products(pages: DataFrame, product: str = "external_product_id") -> DataFrame:
    """First occurrence of each id over all pages, by time, page and position."""
    seen = F.struct("collected_at", "page", "position")
    return pages.groupBy(product).agg(F.min(seen).alias("first")).select(
        product,
        F.col("first.collected_at").alias("first_seen_at"),
        F.col("first.page").alias("first_page"),
        F.col("first.position").alias("first_position"),
    )
