"""Raw marketplace snapshots to the canonical schema, and the row gates behind it."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C


def _or_null(df: DataFrame, name: str, data_type: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(data_type)


def add_missing_columns(df: DataFrame, fields: dict[str, str] | None = None) -> DataFrame:
    """Canonical columns in canonical order; absent ones are typed NULLs, others are dropped."""
    fields = fields or S.RAW_FIELDS
    return df.select(*[_or_null(df, name, t).alias(name) for name, t in fields.items()])


def clean_strings(df: DataFrame) -> DataFrame:
    return df.withColumns({c: C.clean_text(F.col(c)) for c in S.TEXT_COLUMNS})


def normalize_platform(df: DataFrame, platform: str | Column) -> DataFrame:
    return df.withColumn("platform", C.normalize_platform(F.col("platform"), platform))


def cast_measures(df: DataFrame) -> DataFrame:
    return df.withColumns({c: C.measure(F.col(c), S.RAW_FIELDS[c]) for c in S.MEASURE_COLUMNS})


def parse_timestamps(df: DataFrame) -> DataFrame:
    return df.withColumns({c: C.parse_timestamp(F.col(c)) for c in S.TIME_COLUMNS})


def observation_date(df: DataFrame) -> DataFrame:
    return df.withColumn("observation_date", F.to_date("collected_at"))


def null_negative(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or ["price", "original_price", "review_count", "sold_count"]
    return df.withColumns({c: C.null_negative(F.col(c)) for c in columns})


def null_rating_out_of_range(df: DataFrame) -> DataFrame:
    return df.withColumn("rating", C.null_rating_out_of_range(F.col("rating")))


def product_key_cells(platform: Column, external_product_id: Column, fill: str | Column) -> dict[str, Column]:
    """The cells of ``standardize`` that name a product, of raw ones."""
    return {
        "platform": C.normalize_platform(platform, fill),
        "external_product_id": C.clean_text(external_product_id),
    }


def standardize(df: DataFrame, platform: str | Column, clean: Collection[str] = ()) -> DataFrame:
    """Canonical columns plus ``observation_date``, as one projection.

    ``platform`` fills blank platform cells: a name, or a column of ``df`` when
    one frame holds several sources. Columns named in ``clean`` hold clean cells
    already and are taken as they are, so rows dealt by them stay dealt.
    """
    cleaners = {"platform": lambda c: C.normalize_platform(c, platform)}
    cleaners |= {c: C.clean_text for c in S.TEXT_COLUMNS}
    cleaners |= {c: C.parse_timestamp for c in S.TIME_COLUMNS}
    for name in S.MEASURE_COLUMNS:
        keep = {"rating": C.null_rating_out_of_range, "discount_percent": lambda c: c}.get(name, C.null_negative)
        cleaners[name] = lambda c, t=S.RAW_FIELDS[name], keep=keep: keep(C.measure(c, t))
    cleaners |= {name: lambda c: c for name in clean}
    cells = {name: cleaners[name](_or_null(df, name, t)) for name, t in S.RAW_FIELDS.items()}
    return df.select(
        *[cell.alias(name) for name, cell in cells.items()],
        F.to_date(cells["collected_at"]).alias("observation_date"),
    )


def stamp_processed_at(df: DataFrame, at: Column | None = None) -> DataFrame:
    return df.withColumn("processed_at", F.current_timestamp() if at is None else at)


def union_marketplaces(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column one source lacks is NULL for its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_strict(frames: list[DataFrame]) -> DataFrame:
    """Union by name; differing columns or types are an error."""
    first = {f.name: f.dataType for f in frames[0].schema}
    for frame in frames[1:]:
        if {f.name: f.dataType for f in frame.schema} != first:
            raise ValueError(f"schemas differ: {frames[0].schema.simpleString()} / {frame.schema.simpleString()}")
    return reduce(DataFrame.unionByName, frames)


# --- alias resolution and the silver layer -----------------------------------


def resolve_alias(df: DataFrame, candidates: list[str]) -> Column:
    """First candidate the frame has, as text; NULL if it has none."""
    name = next((c for c in candidates if c in df.columns), None)
    return F.col(f"`{name}`").cast("string") if name else F.lit(None).cast("string")


def resolve_alias_columns(df: DataFrame, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    aliases = aliases or S.SILVER_ALIASES
    return df.select(*[resolve_alias(df, names).alias(target) for target, names in aliases.items()])


def silver_projection(df: DataFrame, source: str | Column) -> DataFrame:
    """Common product columns plus the whole source row as JSON text."""
    cells = {target: resolve_alias(df, names) for target, names in S.SILVER_ALIASES.items()}
    return df.select(
        (F.lit(source) if isinstance(source, str) else source).alias("source_system"),
        cells["product_id"].alias("product_id"),
        cells["product_name"].alias("product_name"),
        cells["price_text"].try_cast("double").alias("price"),
        cells["currency"].alias("currency"),
        C.row_to_json(df.columns).alias("source_record_json"),
    )


# --- row filters --------------------------------------------------------------


def filter_valid_core(df: DataFrame) -> DataFrame:
    """Rows with an id, a name and a snapshot day."""
    return df.filter(
        C.not_blank(F.col("external_product_id"))
        & C.not_blank(F.col("product_name"))
        & F.col("observation_date").isNotNull()
    )


def filter_loadable(df: DataFrame) -> DataFrame:
    """Rows the warehouse load accepts: platform, id and day present."""
    return df.filter(
        F.col("platform").isNotNull() & F.col("external_product_id").isNotNull() & F.col("observation_date").isNotNull()
    )


def filter_valid_price_list(df: DataFrame, source: str = "advice_th", currency: str = "THB") -> DataFrame:
    return df.filter(
        (F.col("source_system") == source)
        & F.col("external_product_id").rlike("^A[0-9]+$")
        & C.not_blank(F.col("product_name"))
        & (F.col("price") > 0)
        & (F.col("currency") == currency)
        & F.col("observed_at_utc").isNotNull()
    )


def filter_catalog_dim(df: DataFrame, max_id_length: int = 255) -> DataFrame:
    return df.filter(
        F.length("source_product_id").between(1, max_id_length) & (F.length("product_name") > 0)
    )


def exclude_internal(df: DataFrame, column: str = "source_system") -> DataFrame:
    return df.filter(F.col(column) != S.INTERNAL_SOURCE)
