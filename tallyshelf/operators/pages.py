"""Jobs over a table of web pages: ``page_id``, ``url``, ``html``."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.page_tree import page_products

_COUNTERS = [
    "table_rows", "table_no_single_id", "table_price_not_single", "table_insufficient_cells",
    "table_invalid_name_or_price", "card_links", "card_no_valid_container", "card_no_name", "found",
]
_EXTRACTED = (
    "page_id bigint, url string, mode string, "
    + ", ".join(f"{c} int" for c in _COUNTERS)
    + ", products array<struct<external_product_id:string, product_name:string, price:double, href:string, "
    "description_raw:string>>"
)


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    fields = ["external_product_id", "product_name", "price", "href", "description_raw"]
    for batch in batches:
        out = []
        for page_id, url, html in zip(batch["page_id"], batch["url"], batch["html"]):
            mode, counters, found = page_products(html or "")
            products = [dict(zip(fields, item)) for item in found]
            out.append((page_id, url, mode, *[counters.get(c, 0) for c in _COUNTERS], products))
        yield pd.DataFrame(out, columns=["page_id", "url", "mode", *_COUNTERS, "products"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: mode, reject counters and the products found.

    Each page is parsed where it lies; nothing is shuffled. A page whose table
    gives nothing is read as cards.
    """
    return pages.select("page_id", "url", "html").mapInPandas(_extract, _EXTRACTED)


def _products(extracted: DataFrame, mode: str) -> DataFrame:
    """One row per page, id and price, from its first occurrence on the page; repeats went while the page was read."""
    items = extracted.filter(F.col("mode") == mode).select("page_id", "url", F.explode("products").alias("p"))
    return items.select(
        "page_id", "p.external_product_id", "p.product_name", "p.price", F.lit("THB").alias("currency"),
        X.absolute_url(F.col("url"), F.trim("p.href")).alias("product_url"), F.col("url").alias("source_page"),
        "p.description_raw",
    )


def extract_price_table(pages: DataFrame) -> DataFrame:
    """Products of pages laid out as a price table. An id with two prices on one
    page stays in as two rows; ``conflicting_prices`` reports it."""
    return _products(extract_pages(pages), "table")


def extract_price_cards(pages: DataFrame) -> DataFrame:
    """Products of pages without usable table rows, read from product cards."""
    return _products(extract_pages(pages), "structured_card")


def extraction_diagnostics(pages: DataFrame) -> DataFrame:
    """Pages, products and reject reasons per extraction mode."""
    reasons = [c for c in _COUNTERS if c != "found"]
    return extract_pages(pages).groupBy("mode").agg(
        F.count("*").alias("pages"),
        F.sum("found").alias("products"),
        *[F.sum(c).alias(c) for c in reasons],
    )


def classify_page(pages: DataFrame) -> DataFrame:
    html = F.col("html")
    return pages.select(
        "page_id",
        X.page_class(html).alias("classification"),
        X.product_link_count(html).alias("product_link_count"),
        F.regexp_count(html, F.lit(X.TABLE_ROW)).alias("table_row_count"),
        F.array_join(X.markers_found(html), ",").alias("access_markers"),
        F.lower(html).rlike(X.APP_SHELL).alias("javascript_shell_markers"),
    )


def sanitize_html(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", X.sanitize_html(F.col("html")).alias("html"))


def visible_text(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", X.visible_text(F.col("html")).alias("text"))


def price_context_window(pages: DataFrame, around: int = 3) -> DataFrame:
    contexts = X.price_contexts(X.text_segments(F.col("html")), around)
    return pages.select("page_id", F.explode(contexts).alias("c")).select("page_id", "c.position", "c.context")


def extract_links(pages: DataFrame, product_only: bool = False) -> DataFrame:
    """Distinct absolute links per page. Repeats go inside the page's own array, without a shuffle."""
    hrefs = F.regexp_extract_all(F.col("html"), F.lit(X.ANCHOR_HREF), F.lit(1))
    named = F.array_distinct(F.transform(hrefs, X.link_text))
    links = F.array_distinct(F.transform(named, lambda link: X.absolute_url(F.col("url"), link)))
    out = pages.select("page_id", F.explode(links).alias("link"))
    out = out.withColumn("product_like", X.product_like(F.col("link")))
    return out.filter("product_like") if product_only else out


def extract_jsonld(pages: DataFrame) -> DataFrame:
    """One row per JSON-LD object: type, keys, @graph types, list size; unparsable blocks are flagged."""
    blocks = pages.select(
        "page_id",
        F.posexplode(F.regexp_extract_all(F.col("html"), F.lit(X.JSONLD_BLOCK), F.lit(1))).alias("block", "_text"),
    )
    text = F.trim("_text")
    is_list = text.startswith("[")
    entries = F.when(is_list, F.from_json(text, X.STRING_ARRAY)).otherwise(F.array(F.get_json_object(text, "$")))
    rows = blocks.withColumn("_ok", F.get_json_object(text, "$").isNotNull()).select(
        "page_id", "block", "_ok", F.explode_outer(entries).alias("_entry")
    )
    entry = F.col("_entry")
    graph = F.from_json(F.get_json_object(entry, "$['@graph']"), X.STRING_ARRAY)
    listed = F.from_json(F.get_json_object(entry, "$.itemListElement"), X.STRING_ARRAY)
    return rows.select(
        "page_id", "block", (~F.col("_ok")).alias("parse_failed"),
        F.get_json_object(entry, "$['@type']").alias("type"),
        F.array_join(F.array_sort(F.json_object_keys(entry)), ",").alias("keys"),
        F.array_join(F.transform(graph, lambda g: F.get_json_object(g, "$['@type']")), ",").alias("graph_types"),
        F.when(listed.isNotNull(), F.size(listed)).alias("item_list_count"),
        F.get_json_object(entry, "$.name").alias("name"),
    )


def redirect_price_candidates(pages: DataFrame, around: int = 1200) -> DataFrame:
    """First position of each redirect id on a page and the prices within ``around`` characters.

    One pass over a page finds all its addresses in order; only the short
    fragments leave it, so the work grows with the page, not with page times ids.
    """
    address = re.compile("(?i)" + X.REDIRECT_HOST + X.REDIRECT_ID.removeprefix("(?i)"), re.ASCII)

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page_id, html in zip(batch.column("page_id"), batch.column("html")):
                html = html.as_py() or ""
                first: dict[str, int] = {}
                for found in address.finditer(html):
                    first.setdefault(found[1], found.start())
                if first:
                    at = list(first.values())
                    yield pa.RecordBatch.from_arrays([
                        pa.array([page_id.as_py()] * len(at), batch.schema.field("page_id").type), pa.array(list(first)),
                        pa.array(at, pa.int32()), pa.array([html[max(0, n - around):n + around] for n in at]),
                    ], ["page_id", "redirect_id", "position", "fragment"])

    key = pages.schema["page_id"].dataType.simpleString()
    placed = pages.select("page_id", "html").mapInArrow(
        fragments, f"page_id {key}, redirect_id string, position int, fragment string")
    text = X.collapse_whitespace(X.decode_entities(F.regexp_replace("fragment", r"(?s)<[^>]*>|<[^>]*$", " ")))
    return placed.withColumn("nearby_text", text).select(
        "page_id", "redirect_id", "position",
        F.regexp_extract_all("nearby_text", F.lit(X.THAI_PRICE), F.lit(0)).cast("array<string>").alias("nearby_prices"),
        "nearby_text",
    )


def page_fingerprint(pages: DataFrame) -> DataFrame:
    return pages.select(
        "page_id", F.octet_length("html").cast("bigint").alias("bytes"), F.sha2("html", 256).alias("sha256")
    )

