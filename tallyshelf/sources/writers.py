"""Writers. Output file counts are left to AQE unless a caller asks for a number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.gates import GateError
from ..session import shuffles_freed


def write_partitioned_products(df: DataFrame, path: str, dealt: bool = False) -> None:
    """Overwrite the processed table, one folder per platform.

    Rows are spread by platform and product, so a dominant platform is written
    by many tasks instead of one. ``dealt``: they are spread so (or by day as
    well, as the daily pick leaves them) already and are written where they lie.
    """
    spread = df if dealt else df.repartition("platform", "external_product_id")
    with shuffles_freed(df.sparkSession):
        spread.write.mode("overwrite").partitionBy("platform").parquet(path)


def write_once(df: DataFrame, path: str, files: int | None = None, fmt: str = "parquet") -> None:
    """Fail if the target exists."""
    (df.repartition(files) if files else df).write.mode("errorifexists").format(fmt).save(path)


def write_json_presentation(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_quoted_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """Header, every cell quoted, quotes doubled, NULL as ``\\N``; fails if the target exists."""
    out = df.repartition(files) if files else df
    (
        out.write.mode("errorifexists").option("header", True).option("quoteAll", True)
        .option("escape", '"').option("nullValue", "\\N").csv(path)
    )


def export_dim_csv(df: DataFrame, path: str, source: str, currency: str, exact: int | None = None) -> None:
    """Validate catalog rows by aggregation, then export them; nothing is written on a violation."""
    pid = F.col("external_product_id")
    bad = F.coalesce(
        (F.col("source_system") != source) | (F.col("currency") != currency) | ~pid.startswith("A")
        | (F.col("product_name") == ""), F.lit(True),
    ) | pid.isNull() | F.col("product_name").isNull()
    checked = df.agg(
        F.count("*").alias("n"), F.count_if(bad).alias("bad"), F.countDistinct("external_product_id").alias("ids")
    ).first()
    if checked.bad or checked.ids != checked.n or (exact is not None and checked.n != exact):
        raise GateError(f"catalog rows not exportable: {checked.asDict()}")
    rows = df.select(
        "source_system", pid.alias("source_product_id"), "product_name",
        F.coalesce("category", F.lit("")).alias("category"),
    )
    rows.write.mode("errorifexists").option("header", True).option("emptyValue", "").csv(path)


def price_snapshot_rows(df: DataFrame) -> DataFrame:
    """Price list as exported: price as text with two decimals."""
    return df.select(
        F.col("external_product_id").alias("source_product_id"),
        F.col("price").try_cast("decimal(12,2)").cast("string").alias("price_thb"),
        "observed_at_utc", "price_list_last_update", "source_page",
    )


def export_price_snapshot_csv(df: DataFrame, violations: DataFrame, path: str) -> None:
    """Export a price list whose ``violations`` (see ``validate_price_snapshot``) are empty."""
    if not violations.isEmpty():
        raise GateError("price snapshot has violations")
    price_snapshot_rows(df).write.mode("errorifexists").option("header", True).csv(path)
