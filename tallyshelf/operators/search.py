"""Product and catalog search over the warehouse."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from .. import schemas as S
from .dedupe import latest_fact_per_product

MAX_PAGE_SIZE = 50
_FACT_COLUMNS = [
    "external_fact_key", "product_key", "platform_key", "date_key", "currency", "price", "rating", "review_count",
    "product_url", "collected_at",
]


# Sort: its column, and whether it runs upwards; rows without a value come last either way.
_SORTS = {
    "recent": ("collected_at", False), "price_asc": ("price", True), "price_desc": ("price", False),
    "rating": ("rating", False), "reviews": ("review_count", False),
}


def _sort_order(sort: str) -> Column:
    name, up = _SORTS[sort]
    return F.col(name).asc_nulls_last() if up else F.col(name).desc_nulls_last()


@dataclass
class Page:
    """Rows of a page, how many rows match in all, and where the next page starts (None: this is the last)."""

    items: list[Row]
    total: int
    next: tuple | None


def _behind(sort: str | None, key: str, after: tuple) -> Column:
    """Rows that come after the one with the cursor's sort value and key."""
    value, last = after
    later = F.col(key) > last
    if sort is None:
        return later
    name, up = _SORTS[sort]
    if value is None:
        return F.col(name).isNull() & later
    further = F.col(name) > F.lit(value) if up else F.col(name) < F.lit(value)
    return F.col(name).isNull() | further | ((F.col(name) == F.lit(value)) & later)


def _keyset_page(matched: DataFrame, sort: str | None, key: str, after: tuple | None, size: int) -> Page:
    """The ``size`` rows behind a cursor, in one pass: matches are counted as they stream by, and tasks keep a page each."""
    if not 1 <= size <= MAX_PAGE_SIZE:
        raise ValueError(f"size must be between 1 and {MAX_PAGE_SIZE}")
    seen = Observation()
    rows = matched.observe(seen, F.count(F.lit(1)).alias("total"))
    if after is not None:
        rows = rows.filter(_behind(sort, key, after))
    order = [F.col(key).asc()] if sort is None else [_sort_order(sort), F.col(key).asc()]
    # One row more tells whether there is a next page.
    found = rows.orderBy(*order).limit(size + 1).collect()
    items = found[:size]
    last = (items[-1][_SORTS[sort][0]] if sort else None, items[-1][key]) if len(found) > size else None
    return Page(items, seen.get["total"], last)


def _page(df: DataFrame, order: list[Column], page: int, size: int) -> DataFrame:
    if page < 1 or not 1 <= size <= MAX_PAGE_SIZE:
        raise ValueError(f"page must be >= 1 and size between 1 and {MAX_PAGE_SIZE}")
    return df.orderBy(*order).offset((page - 1) * size).limit(size)


def _contains(q: str, *names: str) -> Column:
    found = F.lit(False)
    for name in names:
        found = found | F.coalesce(F.col(name), F.lit("")).ilike(f"%{q}%")
    return found


def product_search_filter(
    df: DataFrame, q: str | None = None, platforms: list[str] | None = None, currency: str | None = None,
    min_price: float | None = None, max_price: float | None = None,
) -> DataFrame:
    """Search conditions; one that is not given filters nothing."""
    if min_price is not None and max_price is not None and min_price > max_price:
        raise ValueError("min_price must not exceed max_price")
    unknown = set(platforms or []) - set(S.SEARCHABLE_PLATFORMS)
    if unknown:
        raise ValueError(f"unsupported marketplace: {sorted(unknown)}")
    if q is not None:
        df = df.filter(_contains(q, "product_name", "brand", "category"))
    if platforms:
        df = df.filter(F.col("platform_name").isin(platforms))
    if currency is not None:
        df = df.filter(F.col("currency") == currency)
    if min_price is not None:
        df = df.filter(F.col("price") >= min_price)
    if max_price is not None:
        df = df.filter(F.col("price") <= max_price)
    return df


def product_search(
    wh: dict[str, DataFrame], q: str | None = None, platforms: list[str] | None = None, currency: str | None = None,
    min_price: float | None = None, max_price: float | None = None, some_products: bool = False,
) -> DataFrame:
    """Latest fact per product and platform that matches, without order.

    ``some_products``: ``wh["dim_product"]`` holds only the products wanted.

    Text and platform conditions concern the whole product-platform group, so
    they run before the newest fact is picked and cut the facts to shuffle.
    Currency and price belong to the newest fact itself and are tested after.
    """
    products = wh["dim_product"].select("product_key", "product_name", "category", "brand")
    if q is not None:
        products = products.filter(_contains(q, "product_name", "brand", "category"))
    names = wh["dim_platform"].select("platform_key", "platform_name")
    if platforms:
        names = names.filter(F.col("platform_name").isin(platforms))
    facts = (
        wh["fact_external_product"].select(*_FACT_COLUMNS)
        .join(names.select("platform_key"), "platform_key", "left_semi")
    )
    if q is not None or some_products:
        facts = facts.join(products.select("product_key"), "product_key", "left_semi")
    latest = product_search_filter_latest(latest_fact_per_product(facts), currency, min_price, max_price)
    joined = (
        latest.join(products, "product_key").join(names, "platform_key")
        .join(wh["dim_date"].select("date_key", "full_date"), "date_key")
    )
    # Also rejects unknown marketplaces and crossed price bounds.
    matched = product_search_filter(joined, None, platforms, currency, min_price, max_price)
    return matched.select(
        "external_fact_key", "product_key", "product_name", "category", "brand", "platform_name", "currency", "price",
        "rating", "review_count", "product_url", "collected_at", "full_date",
    )


def product_search_filter_latest(
    latest: DataFrame, currency: str | None, min_price: float | None, max_price: float | None
) -> DataFrame:
    return product_search_filter(latest, currency=currency, min_price=min_price, max_price=max_price)


def product_search_page(
    wh: dict[str, DataFrame], sort: str = "recent", page: int = 1, size: int = 20, **conditions
) -> DataFrame:
    """One page; the fact key makes the order total, so pages never overlap."""
    return _page(product_search(wh, **conditions), [_sort_order(sort), F.col("external_fact_key").asc()], page, size)


def product_search_after(
    wh: dict[str, DataFrame], sort: str = "recent", after: tuple | None = None, size: int = 20, **conditions
) -> Page:
    """The page behind ``after`` (``Page.next`` of the one before), with the total, from one pass.

    However far one has paged, no task sorts or keeps more than a page: the
    cursor is a condition on the sort value and the fact key, not a number of
    rows to skip.
    """
    return _keyset_page(product_search(wh, **conditions), sort, "external_fact_key", after, size)


def product_search_total(wh: dict[str, DataFrame], **conditions) -> DataFrame:
    return product_search(wh, **conditions).agg(F.count("*").alias("total"))


def catalog_search_filter(
    dim_product: DataFrame, q: str | None = None, category: str | None = None, brand: str | None = None
) -> DataFrame:
    df = dim_product.filter(F.col("source_system") == S.CATALOG_SOURCE)
    if q is not None:
        df = df.filter(_contains(q, "product_name", "source_product_id"))
    if category is not None:
        df = df.filter(F.col("category") == category)
    if brand is not None:
        df = df.filter(F.col("brand") == brand)
    return df.select("product_key", "source_product_id", "product_name", "category", "brand")


def catalog_search_page(dim_product: DataFrame, page: int = 1, size: int = 20, **conditions) -> DataFrame:
    return _page(catalog_search_filter(dim_product, **conditions), [F.col("product_key").asc()], page, size)


def catalog_search_after(dim_product: DataFrame, after: tuple | None = None, size: int = 20, **conditions) -> Page:
    """``product_search_after`` for the catalog, in the order of the product key."""
    return _keyset_page(catalog_search_filter(dim_product, **conditions), None, "product_key", after, size)


def catalog_search_total(dim_product: DataFrame, **conditions) -> DataFrame:
    return catalog_search_filter(dim_product, **conditions).agg(F.count("*").alias("total"))


def platform_list(dim_platform: DataFrame) -> DataFrame:
    return (
        dim_platform.filter(F.col("platform_type") != "internal")
        .select("platform_name", "platform_type").orderBy("platform_name")
    )


def sample_limit(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows in a total order, so a repeat gives the same rows."""
    return df.orderBy(*order).limit(n)
