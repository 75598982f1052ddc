"""Source-specific records to the canonical snapshot columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from .dedupe import pick_first
from .standardize import filter_valid_core

HISTORICAL_REFERENCE_DATE = "2023-09-30"


def _canonical(df: DataFrame, cells: dict[str, Column], types: dict[str, str] | None = None) -> DataFrame:
    types = S.RAW_FIELDS | (types or {})
    return df.select(*[cells.get(n, F.lit(None)).cast(types[n]).alias(n) for n in S.RAW_FIELDS])


def amazon_historical_adapter(df: DataFrame, reference_date: str = HISTORICAL_REFERENCE_DATE) -> DataFrame:
    """Catalog metadata as historical rows of one fixed reference date, one per id.

    The collection time stays NULL: the source has no observation time.
    """
    pid = F.trim("parent_asin")
    rows = _canonical(df, {
        "platform": F.lit(S.CATALOG_SOURCE),
        "external_product_id": pid,
        "product_name": F.trim("title"),
        "category": C.category_from_array(F.col("categories"), F.col("main_category")),
        "currency": F.lit("USD"),
        "price": C.parse_price_text(F.col("price")),
        "rating": C.null_rating_out_of_range(F.col("average_rating")),
        "review_count": C.null_negative(F.col("rating_number")),
        "seller_name": F.col("store"),
        "product_url": C.product_url_from_id(pid),
        "raw_source": F.lit("amazon_reviews_2023_historical_metadata"),
    })
    valid = rows.filter((F.length("external_product_id") > 0) & (F.length("product_name") > 0))
    unique = pick_first(valid, ["external_product_id"], [F.length("product_name").desc()])
    return unique.select(*S.RAW_COLUMNS, F.lit(reference_date).cast("date").alias("observation_date"))


def hybrid_csv_adapter(df: DataFrame, platform: str, mapping: dict[str, str] | None = None) -> DataFrame:
    """All-text CSV rows to typed canonical rows through a column mapping, one per id."""
    mapping = mapping or S.CSV_SOURCES[platform]

    def field(name: str) -> Column:
        source = mapping.get(name)
        return C.null_tokens(F.col(f"`{source}`")) if source in df.columns else F.lit(None).cast("string")

    rows = _canonical(df, {
        "platform": F.lit(platform),
        "currency": F.lit("USD"),
        "price": C.null_negative(C.measure(field("price"), "double")),
        "rating": C.null_rating_out_of_range(C.measure(field("rating"), "double")),
        "review_count": C.null_negative(C.measure(field("review_count"), "bigint")),
        "collected_at": C.parse_timestamp_pattern(field("collected_at")),
        "raw_source": F.lit("historical_csv"),
        **{n: field(n) for n in
           ["external_product_id", "product_name", "category", "brand", "seller_name", "product_url"]},
    })
    valid = filter_valid_core(rows.withColumn("observation_date", F.to_date("collected_at")))
    return pick_first(valid, ["platform", "external_product_id"], [F.col("collected_at").desc_nulls_last()])


def advice_adapter(products: DataFrame, source: str = "advice_th") -> DataFrame:
    """Price-list products to canonical raw columns (times still text)."""
    observed = F.col("observed_at_utc")
    return _canonical(products, {
        "platform": F.lit(source),
        "external_product_id": C.strip_whitespace(F.col("external_product_id")),
        "product_name": C.strip_whitespace(F.col("product_name")),
        "category": F.col("category"),
        "currency": F.lit("THB"),
        "price": F.col("price"),
        "product_url": C.strip_whitespace(F.col("product_url")),
        "collected_at": observed,
        "source_updated_at": F.col("price_list_last_update"),
        "ingestion_timestamp": observed,
        "raw_source": F.lit(f"{source}_public_price_list"),
    }, {c: "string" for c in S.TIME_COLUMNS})


def listing_items(pages: DataFrame) -> DataFrame:
    """Listing pages to one row per item with its page and position."""
    return pages.select(
        "keyword", "offset", F.col("collected_at"), F.posexplode("results").alias("position", "item")
    ).select("keyword", "offset", "collected_at", "position", "item.*")


def etsy_adapter(items: DataFrame, raw_source: str = "etsy_open_api_v3_active_bulk") -> DataFrame:
    """Listing items to canonical raw columns; items without id or title are dropped."""
    listing = items.filter(C.strip_whitespace(F.col("listing_id")).rlike(".") & C.strip_whitespace(F.col("title")).rlike("."))
    return _canonical(listing, {
        "platform": F.lit("etsy"),
        "external_product_id": F.col("listing_id"),
        "product_name": F.col("title"),
        "currency": F.col("price.currency_code"),
        "price": C.money_struct_to_price(F.col("price")),
        "product_url": F.col("url"),
        "collected_at": C.to_utc_naive(F.col("collected_at")),
        "source_updated_at": C.epoch_to_timestamp(F.col("updated_timestamp")),
        "ingestion_timestamp": C.to_utc_naive(F.col("collected_at")),
        "raw_source": F.lit(raw_source),
    })


def rakuten_adapter(items: DataFrame, raw_source: str = "rakuten_item_search") -> DataFrame:
    """Item code, name and price with the collection time to canonical raw columns."""
    return _canonical(items, {
        "platform": F.lit("rakuten"),
        "external_product_id": C.clean_text(F.col("itemCode")),
        "product_name": C.clean_text(F.col("itemName")),
        "currency": F.lit("JPY"),
        "price": C.measure(F.col("itemPrice"), "double"),
        "collected_at": C.parse_timestamp(F.col("collected_at")),
        "ingestion_timestamp": C.parse_timestamp(F.col("collected_at")),
        "raw_source": F.lit(raw_source),
    })
