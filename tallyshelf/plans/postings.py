"""Substring search over stored postings: where every three-character piece of a name stands."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import search
from ..session import partitions
from .warehouse import CODEC, _PART as PART, PARTS, Warehouse

SIZE = 3
FIELDS = ["product_name", "brand", "category", "source_product_id"]


def pieces(products: DataFrame) -> DataFrame:
    """(part, product_key, field, place, piece) of every piece of the lower-cased fields; a shorter field has none."""
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.lower(f).alias("text")) for f in FIELDS])
    texts = products.select(PART, "product_key", F.inline(cells)).filter(F.length("text") >= SIZE)
    found = F.transform(F.sequence(F.lit(1), F.length("text") - (SIZE - 1)), lambda i: F.substr("text", i, F.lit(SIZE)))
    return texts.select(PART, "product_key", "field", F.posexplode(found).alias("place", "piece"))


def dealt_pieces(wh: Warehouse, parts: list[int] | None = None) -> DataFrame:
    """``pieces`` as they are written.

    Products are dealt before their fields are cut, by part and slices of a part,
    so a name travels once, not once for each of its places, and a frequent piece
    is split. Rows are sorted by piece, so a search skips pages without its pieces, and by product, so they are stored small.
    """
    n = partitions(wh.spark)
    slice_of_part = F.pmod(F.xxhash64("product_key"), F.lit(-(-n // PARTS)))
    products = wh.parts("dim_product", parts).select(PART, "product_key", *FIELDS).repartition(n, PART, slice_of_part)
    return pieces(products).sortWithinPartitions(PART, "piece", "product_key")


def write_postings(wh: Warehouse, path: str, parts: list[int] | None = None) -> None:
    """Postings of all products, or anew for the parts of the dimension that a load has overwritten."""
    dealt_pieces(wh, parts).write.partitionBy(PART).mode("overwrite").option(
        "partitionOverwriteMode", "static" if parts is None else "dynamic").parquet(path, compression=CODEC)


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"product_key long, field string, place int, piece string, {PART} int").parquet(path)


def holding(postings: DataFrame, q: str, fields: list[str]) -> DataFrame | None:
    """(part, product_key) of the products with ``q`` in one of ``fields``, case left aside.

    All pieces of the pattern must stand at their distances from one start, so
    the postings alone decide and no name is read. None where they can't tell: a
    pattern of fewer than three characters, or one with ``%``, ``_`` or ``\\``,
    which a pattern of ``ilike`` takes as signs.
    """
    if any(c in q for c in "%_\\"):
        return None
    low = postings.sparkSession.sql("SELECT lower(:q)", {"q": q}).first()[0]
    if len(low) < SIZE:
        return None
    at: dict[str, list[int]] = {}
    for n in range(len(low) - SIZE + 1):
        at.setdefault(low[n:n + SIZE], []).append(n)
    places = F.create_map(*[F.lit(x) for piece, ns in at.items() for x in (piece, ns)])
    hits = postings.filter(F.col("piece").isin(list(at)) & F.col("field").isin(fields)).select(
        PART, "product_key", "field", "place", F.explode(places[F.col("piece")]).alias("_n"))
    starts = hits.groupBy(PART, "product_key", "field", (F.col("place") - F.col("_n")).alias("start")).agg(F.count(F.lit(1)).alias("met"))
    return starts.filter(F.col("met") == len(low) - SIZE + 1).select(PART, "product_key").distinct()


def products_holding(wh: Warehouse, postings: DataFrame, q: str, fields: list[str]) -> DataFrame | None:
    """The products themselves, read from the parts of the dimension that hold one; None as for ``holding``."""
    found = holding(postings, q, fields)
    if found is None:
        return None
    parts = [r[0] for r in found.select(PART).distinct().collect()]  # at most as many as the dimension has
    return wh.parts("dim_product", parts).join(found, [PART, "product_key"], "left_semi").drop(PART)


def product_search(wh: Warehouse, postings: DataFrame, q: str, **conditions) -> DataFrame:
    """``search.product_search`` with the pattern met by postings; by a scan of the names where they can't tell."""
    found = products_holding(wh, postings, q, ["product_name", "brand", "category"])
    if found is None:
        return search.product_search(wh.frames(), q, **conditions)
    return search.product_search({**wh.frames(), "dim_product": found}, some_products=True, **conditions)


def catalog_search(wh: Warehouse, postings: DataFrame, q: str, **conditions) -> DataFrame:
    """``search.catalog_search_filter`` in the same way."""
    found = products_holding(wh, postings, q, ["product_name", "source_product_id"])
    if found is None:
        return search.catalog_search_filter(wh.read("dim_product"), q, **conditions)
    return search.catalog_search_filter(found, **conditions)
