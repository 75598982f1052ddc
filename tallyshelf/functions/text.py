"""HTML and keyword expressions on whole page texts, JVM-side."""

from __future__ import annotations

import html.entities
import json
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .columns import collapse_whitespace

# Fixed values.
BLOCK_MARKERS = [
    "access denied", "captcha", "cf-chl", "challenges.cloudflare.com", "just a moment", "forbidden",
    "bot protection", "verify you are human", "attention required",
]
PRODUCT_LINK = r"(?i)href\s*=\s*['\"]([^'\"]*productdetail/A\d+[^'\"]*)"
TABLE_ROW = r"(?i)<tr\b"
APP_SHELL = r"id\s*=\s*['\"](?:root|app|__next)['\"]|__next_data__|webpack"
SCRIPT_BLOCK = r"(?is)<script\b[^>]*>.*?</script\s*>"
INPUT_TAG = r"(?is)<input\b[^>]*>"
SENSITIVE_ATTRIBUTE = (
    r"(?is)\s(?:value|content|data-[\w-]*(?:token|session|auth|csrf)[\w-]*)\s*=\s*(?:'.*?'|\".*?\")"
)
HIDDEN_BLOCK = (
    r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
    r"|<svg\b[^>]*>.*?</svg\s*>|<noscript\b[^>]*>.*?</noscript\s*>"
)
ANY_TAG = r"(?s)<[^>]*>"
# Quoted values may hold spaces; the opening quote stays with the value and is taken off later.
ANCHOR_HREF = r"(?is)<a\b[^>]*?\shref\s*=\s*([\"'][^\"'>]*|[^\s\"'>]+)"
JSONLD_BLOCK = r"(?is)<script[^>]*type\s*=\s*[\"']application/ld\+json[\"'][^>]*>(.*?)</script\s*>"
REDIRECT_ID = r"(?i)/r/redirect\?id=(\d+)"
REDIRECT_HOST = r"(?:https?://(?:www\.)?priceza\.com)?"
THAI_PRICE = r"(?:฿\s*[\d,]+(?:\.\d{1,2})?|[\d,]+(?:\.\d{1,2})?\s*บาท)"
CONTEXT_PRICE = r"฿|บาท|\b\d{1,3}(?:,\d{3})+(?:\.\d{2})?\b"
PRODUCT_LIKE = ["product", "item", "detail"]
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


# The references met most, looked for before the full list.
_COMMON = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " "}
_NAMED = {k[:-1]: v.replace("\xa0", " ") for k, v in html.entities.html5.items() if k.endswith(";")}


def markers_found(html: Column) -> Column:
    lowered = F.lower(html)
    return F.array_compact(F.array(*[F.when(lowered.contains(m), F.lit(m)) for m in BLOCK_MARKERS]))


def product_link_count(html: Column) -> Column:
    return F.regexp_count(html, F.lit(PRODUCT_LINK))


def page_class(html: Column) -> Column:
    """Blocked, product listing, client-rendered shell, or other; the first that applies."""
    return (
        F.when(F.size(markers_found(html)) > 0, "access_or_bot_protection")
        .when(html.rlike(PRODUCT_LINK), "server_rendered_product_listing")
        .when(F.lower(html).rlike(APP_SHELL), "javascript_shell_or_client_rendered_page")
        .otherwise("other_or_unrecognized_html")
    )


def sanitize_html(html: Column) -> Column:
    """Without scripts, inputs and attributes that may hold secrets."""
    out = F.regexp_replace(html, SCRIPT_BLOCK, "<!-- script removed -->")
    out = F.regexp_replace(out, INPUT_TAG, "<!-- input removed -->")
    return F.regexp_replace(out, SENSITIVE_ATTRIBUTE, ' data-redacted="true"')


def decode_entities(text: Column) -> Column:
    """Character references, numeric and named, as the characters they mean; unknown ones stay as written.

    Each distinct reference of a text is replaced once, ``&amp;`` last, so what
    it uncovers is not decoded again. A no-break space becomes a space.
    """
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)))
    ordered = F.concat(F.filter(found, lambda r: r != "&amp;"), F.filter(found, lambda r: r == "&amp;"))
    # Names in groups by their first two letters: a map is searched from its start, so each is kept short.
    groups: dict[str, dict[str, str]] = {}
    for name, char in _NAMED.items():
        groups.setdefault(name[:2], {})[name] = char
    names = F.from_json(F.lit(json.dumps(groups)), "map<string,map<string,string>>")

    def named(reference: Column) -> Column:
        name = F.substring_index(F.substring(reference, 2, 40), ";", 1)
        common = F.lit(None).cast("string")
        for word, char in _COMMON.items():
            common = F.when(name == word, char).otherwise(common)
        return F.coalesce(common, F.try_element_at(F.try_element_at(names, F.substring(name, 1, 2)), name))

    def meaning(reference: Column) -> Column:
        hexadecimal = F.lower(F.substring(reference, 3, 1)) == "x"
        digits = F.regexp_extract(reference, r"([0-9a-fA-F]+);$", 1)
        code = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).try_cast("int")
        # Code points that no text can hold stay as written.
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(F.substring(reference, 2, 1) != "#", named(reference)).when(
            valid, F.when(code == 160, " ").otherwise(char)
        )

    decoded = F.aggregate(ordered, text, lambda out, r: F.replace(out, r, F.coalesce(meaning(r), r)))
    return F.when(text.contains("&"), decoded).otherwise(text)


def visible_text(html: Column) -> Column:
    without_hidden = F.regexp_replace(html, HIDDEN_BLOCK, " ")
    return collapse_whitespace(decode_entities(F.regexp_replace(without_hidden, ANY_TAG, " ")))


def text_segments(html: Column) -> Column:
    """Non-blank pieces of visible text between tags, in page order."""
    marked = F.regexp_replace(F.regexp_replace(html, HIDDEN_BLOCK, "\u0001"), ANY_TAG, "\u0001")
    pieces = F.transform(F.split(marked, "\u0001"), lambda s: collapse_whitespace(decode_entities(s)))
    return F.filter(pieces, lambda s: s != "")


def price_contexts(segments: Column, around: int = 3) -> Column:
    """For each segment with a price: its position and the text of its neighbourhood.

    Works inside the page's own array, so no page is exploded and shuffled. The
    outer one-element array binds the segments to a variable: they are split
    once per page, not once per segment.
    """

    def contexts(pieces: Column) -> Column:
        positions = F.when(F.size(pieces) > 0, F.sequence(F.lit(1), F.size(pieces)))
        priced = F.filter(positions, lambda i: F.element_at(pieces, i).rlike(CONTEXT_PRICE))

        def context(i: Column) -> Column:
            start = F.greatest(F.lit(1), i - around)
            return F.struct(
                (i - 1).alias("position"),
                F.concat_ws(" ", F.slice(pieces, start, i + around - start + 1)).alias("context"),
            )

        return F.transform(priced, context)

    return F.get(F.transform(F.array(segments), contexts), 0)


def _without_dot_segments(path: Column) -> Column:
    parts = F.split(path, "/")
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda acc, part: F.when(part == ".", acc)
        .when(part == "..", F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.array_append(acc, part)),
    )
    directory = F.element_at(parts, -1).isin(".", "..")
    return F.concat(F.array_join(kept, "/"), F.when(directory, "/").otherwise(""))


def link_text(href: Column) -> Column:
    """An href attribute as written to the address it means."""
    return F.trim(decode_entities(F.regexp_replace(href, "^[\"']", "")))


def absolute_url(base: Column, link: Column) -> Column:
    """``link`` resolved against the page address."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_replace(base, r"[?#].*$", "")
    path = F.substring(page, F.length(origin) + 1, F.length(page))
    folder = F.concat(F.regexp_replace(path, r"[^/]*$", ""), F.when(path == "", "/").otherwise(""))
    joined = F.when(link.startswith("/"), link).otherwise(F.concat(folder, link))
    target, rest = F.regexp_extract(joined, r"^([^?#]*)", 1), F.regexp_extract(joined, r"^[^?#]*(.*)$", 1)
    resolved = F.when(target.rlike(r"(^|/)\.\.?(/|$)"), _without_dot_segments(target)).otherwise(target)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link == "", base)
        .when(link.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), link))
        .when(link.startswith("?"), F.concat(page, link))
        .otherwise(F.concat(origin, resolved, rest))
    )


def product_like(url: Column) -> Column:
    found = F.lit(False)
    for term in PRODUCT_LIKE:
        found = found | F.lower(url).contains(term)
    return found


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Unicode compatibility composition, which Spark has no built-in for."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def split_words(text: Column) -> Column:
    """Comma- or line-separated words, in order, blanks dropped."""
    trimmed = F.transform(F.split(text, r"[,\n]"), lambda w: F.regexp_replace(w, r"^\s+|\s+$", ""))
    return F.filter(trimmed, lambda w: w != "")


def strip_unicode(text: Column) -> Column:
    """Without white space of any script at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


STRING_ARRAY = ArrayType(StringType())
