"""Canonical product snapshot, warehouse tables and the fixed values of the domain."""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical raw product snapshot, in order. The first group is text.
RAW_FIELDS: dict[str, str] = {
    "platform": "string",
    "external_product_id": "string",
    "product_name": "string",
    "category": "string",
    "brand": "string",
    "currency": "string",
    "price": "double",
    "original_price": "double",
    "discount_percent": "double",
    "rating": "double",
    "review_count": "bigint",
    "sold_count": "bigint",
    "seller_name": "string",
    "product_url": "string",
    "image_url": "string",
    "collected_at": "timestamp",
    "source_updated_at": "timestamp",
    "ingestion_timestamp": "timestamp",
    "raw_source": "string",
}
RAW_COLUMNS = list(RAW_FIELDS)
STANDARD_COLUMNS = RAW_COLUMNS + ["observation_date"]
TEXT_COLUMNS = [c for c, t in RAW_FIELDS.items() if t == "string" and c != "platform"]
MEASURE_COLUMNS = [c for c, t in RAW_FIELDS.items() if t in ("double", "bigint")]
TIME_COLUMNS = [c for c, t in RAW_FIELDS.items() if t == "timestamp"]

# Keys
SNAPSHOT_KEY = ["platform", "external_product_id", "observation_date"]
PRODUCT_KEY = ["source_system", "source_product_id"]
FACT_KEY = ["date_key", "product_key", "platform_key"]
SALES_KEY = ["order_id", "product_key"]

# Default platform rows, in key order.
DEFAULT_PLATFORMS = [
    ("internal", "internal"),
    ("ebay", "marketplace"),
    ("rakuten", "marketplace"),
    ("stockx", "marketplace"),
    ("etsy", "marketplace"),
    ("advice_th", "marketplace"),
    ("amazon_2023", "marketplace"),
]
# Platforms a product search may name.
SEARCHABLE_PLATFORMS = ["ebay", "etsy", "rakuten", "stockx", "advice_th"]
CATALOG_SOURCE = "amazon_2023"
INTERNAL_SOURCE = "internal"

_TYPES = {
    "int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType(), "date": T.DateType(),
    "timestamp": T.TimestampType(), "boolean": T.BooleanType(),
    **{f"decimal({p},{s})": T.DecimalType(p, s) for p, s in [(18, 4), (10, 4), (5, 2), (12, 2), (14, 2)]},
}


def _table(columns: str) -> T.StructType:
    """Flat schema from ``name type`` pairs; unlike a DDL string it needs no running session."""
    pairs = [c.split(" ") for c in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[data_type]) for name, data_type in pairs])


DIM_DATE = _table(
    "date_key int, full_date date, day int, month int, month_name string, quarter int, "
    "year int, day_of_week int, day_name string, is_weekend boolean"
)
DIM_PLATFORM = _table("platform_key int, platform_name string, platform_type string")
DIM_PRODUCT = _table(
    "product_key bigint, source_system string, source_product_id string, product_name string, "
    "category string, brand string, sku string, created_at timestamp, updated_at timestamp"
)
DIM_CUSTOMER = _table(
    "customer_key bigint, source_customer_id bigint, customer_code string, gender string, age int, "
    "province string, region string, registered_at timestamp, created_at timestamp"
)
FACT_SALES = _table(
    "sales_key bigint, order_id bigint, order_number string, date_key int, product_key bigint, "
    "customer_key bigint, platform_key int, quantity int, unit_price decimal(12,2), "
    "discount_amount decimal(12,2), line_total decimal(14,2), payment_method string, "
    "sales_channel string, order_status string, loaded_at timestamp"
)
FACT_EXTERNAL = _table(
    "external_fact_key bigint, date_key int, product_key bigint, platform_key int, currency string, "
    "price decimal(18,4), original_price decimal(18,4), discount_percent decimal(10,4), "
    "rating decimal(5,2), review_count bigint, sold_count bigint, seller_name string, "
    "product_url string, collected_at timestamp, processed_at timestamp, loaded_at timestamp"
)
WAREHOUSE = {
    "dim_date": DIM_DATE,
    "dim_platform": DIM_PLATFORM,
    "dim_product": DIM_PRODUCT,
    "dim_customer": DIM_CUSTOMER,
    "fact_sales": FACT_SALES,
    "fact_external_product": FACT_EXTERNAL,
}

CATALOG_JSON = (
    "parent_asin string, title string, main_category string, categories array<string>, "
    "price string, average_rating double, rating_number bigint, store string"
)
LISTING_PAGE_JSON = (
    "keyword string, offset int, `limit` int, `count` int, collected_at string, "
    "results array<struct<listing_id:string, title:string, url:string, updated_timestamp:bigint, "
    "price:struct<amount:string, divisor:string, currency_code:string>>>"
)
PRICE_LIST_JSON = (
    "dataset string, source_url string, observed_at_utc string, product_count int, "
    "products array<struct<source_system:string, source_type:string, external_product_id:string, "
    "product_name:string, category:string, price:double, currency:string, product_url:string, "
    "source_page:string, description_raw:string, observed_at_utc:string, "
    "price_list_last_update:string, sold_count:bigint, sales_rank:bigint>>"
)

# Source names that may stand for one silver column, first match wins.
SILVER_ALIASES = {
    "product_id": ["external_product_id", "product_id", "external_id", "item_id", "itemCode", "id", "sku"],
    "product_name": ["product_name", "item_name", "itemName", "title", "name"],
    "price_text": ["price", "itemPrice", "current_price", "price_amount", "price_value"],
    "currency": ["currency", "currency_code"],
}
# Source names that may stand for one catalog column.
CATALOG_ALIASES = {
    "id": ["parent_asin", "asin"],
    "product_name": ["title", "product_title"],
    "price": ["price", "priceUSD"],
    "observation_date": ["collected_at", "observation_date", "price_date", "timestamp"],
    "rating": ["average_rating", "rating"],
    "review_count": ["rating_number", "review_count"],
    "category": ["main_category", "categories"],
    "brand": ["store", "brand"],
}
# Column mapping of the two historical CSV sources.
CSV_SOURCES = {
    "amazon_csv": {
        "external_product_id": "asin", "product_name": "title", "price": "final_price",
        "rating": "rating", "review_count": "reviews_count", "seller_name": "seller_name",
        "category": "categories", "brand": "brand", "product_url": "url", "collected_at": "timestamp",
    },
    "walmart_csv": {
        "external_product_id": "product_id", "product_name": "product_name", "price": "final_price",
        "rating": "rating", "review_count": "review_count", "seller_name": "seller",
        "category": "category_name", "brand": "brand", "product_url": "url", "collected_at": "timestamp",
    },
}
