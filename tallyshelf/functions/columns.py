"""Cleaning and typing expressions.

Every function takes and returns a ``Column`` so the optimizer sees plain
expressions it can push down and compile. Bad input becomes NULL (``try_*``):
with ANSI mode on, an ordinary cast would fail the whole job for one bad row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NULL_TOKENS = ["", "null", "None", "N/A"]
PLAIN_NUMBER = r"^\d+(\.\d+)?$"
BAHT_PRICE = r"฿\s*([\d,]+(?:\.\d{1,2})?)"
CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSS"
CATALOG_URL_PREFIX = "https://www.amazon.com/dp/"
UNCATEGORIZED = "Uncategorized"
PRICE_BANDS = [
    (25, "< 25"),
    (50, "25-49.99"),
    (100, "50-99.99"),
    (250, "100-249.99"),
    (500, "250-499.99"),
]
TOP_PRICE_BAND = "500+"
MISSING_PRICE_BAND = "Missing price"


def clean_text(c: Column) -> Column:
    return F.trim(c.cast("string"))


def strip_whitespace(c: Column) -> Column:
    """Trim every kind of whitespace, not only spaces."""
    return F.regexp_replace(c.cast("string"), r"^\s+|\s+$", "")


def collapse_whitespace(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def not_blank(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def blank_to_default(c: Column, default: str = UNCATEGORIZED) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(default))


def null_tokens(c: Column) -> Column:
    value = clean_text(c)
    return F.when(~value.isin(NULL_TOKENS), value)


def strip_nul(c: Column) -> Column:
    return F.regexp_replace(c, r"\u0000", "")


def normalize_platform(c: Column, default: Column | str) -> Column:
    fallback = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(F.nullif(F.lower(clean_text(c)), F.lit("")), fallback)


def measure(c: Column, data_type: str) -> Column:
    """Number from a number or text column; unparsable text is NULL."""
    return c.try_cast(data_type)


def parse_timestamp(c: Column) -> Column:
    return F.try_to_timestamp(c.cast("string"))


def parse_timestamp_pattern(c: Column, pattern: str = CSV_TIMESTAMP) -> Column:
    return F.try_to_timestamp(c, F.lit(pattern))


def to_utc_naive(c: Column) -> Column:
    """Text with an optional zone offset to the UTC instant (session zone is UTC)."""
    return F.try_to_timestamp(strip_whitespace(c))


def epoch_to_timestamp(c: Column) -> Column:
    """Seconds since 1970 to a timestamp; NULL for what is no number or lies outside the years 1 to 9999."""
    seconds = c.try_cast("bigint")
    return F.when(seconds.between(-62_135_596_800, 253_402_300_799), F.timestamp_seconds(seconds))


def null_negative(c: Column) -> Column:
    """Also NULL: NaN and infinity, which no measure is and which would spoil an average."""
    return F.when((c >= 0) & (c.cast("double") < F.lit(float("inf"))), c)


def null_rating_out_of_range(c: Column) -> Column:
    return F.when(c.between(0, 5), c)


def parse_price_text(c: Column) -> Column:
    """Price only if the text is a plain decimal number."""
    text = F.trim(c)
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def parse_currency_price(c: Column) -> Column:
    """The single baht price in a text; none or several is NULL."""
    found = F.regexp_extract_all(c, F.lit(BAHT_PRICE), F.lit(1))
    return F.when(F.size(found) == 1, F.replace(F.get(found, 0), F.lit(","), F.lit("")).try_cast("double"))


def money_struct_to_price(c: Column) -> Column:
    """``amount / divisor`` of a money struct, NULL unless the divisor is positive."""
    divisor = c["divisor"].try_cast("double")
    return F.when(divisor > 0, c["amount"].try_cast("double") / divisor)


def bound_price(c: Column) -> Column:
    """Keep what fits NUMERIC(18,4)."""
    return F.when(F.abs(c) < 1e14, F.round(c, 4))


def fallback_product_name(name: Column, product_id: Column, source_label: str) -> Column:
    return F.coalesce(
        F.nullif(strip_whitespace(name), F.lit("")),
        F.concat(F.lit(f"{source_label} product "), product_id),
    )


def category_from_array(categories: Column, main: Column) -> Column:
    return F.coalesce(F.get(categories, 0), main)


def category_or_json(main: Column, categories: Column) -> Column:
    return F.coalesce(main, F.to_json(categories))


def product_url_from_id(product_id: Column, prefix: str = CATALOG_URL_PREFIX) -> Column:
    return F.concat(F.lit(prefix), product_id)


def price_band(price: Column) -> Column:
    band = F.when(price.isNull(), MISSING_PRICE_BAND)
    for upper, label in PRICE_BANDS:
        band = band.when(price < upper, label)
    return band.otherwise(TOP_PRICE_BAND)


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def iso_weekday(day: Column) -> Column:
    """Monday 1 .. Sunday 7."""
    return F.extract(F.lit("dayofweek_iso"), day).cast("int")


def sunday_zero_weekday(day: Column) -> Column:
    """Sunday 0 .. Saturday 6."""
    return (F.dayofweek(day) - 1).cast("int")


def date_attributes(day: Column, style: str | Column = "iso") -> list[Column]:
    """The ten calendar columns of a day; ``style`` is ``iso`` or ``sunday0``."""
    if isinstance(style, str):
        weekday = {"iso": iso_weekday, "sunday0": sunday_zero_weekday}[style](day)
    else:
        weekday = F.when(style == "sunday0", sunday_zero_weekday(day)).otherwise(iso_weekday(day))
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        iso_weekday(day).isin(6, 7).alias("is_weekend"),
    ]


def row_to_json(columns: list[str]) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in columns]))
