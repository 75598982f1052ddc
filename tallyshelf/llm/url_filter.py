"""URL lists with dated entries, held against captures at their fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh


def intervals(entries: DataFrame) -> DataFrame:
    """(list_name, pattern, valid_from, valid_to): when each entry was active; valid_to is null where it still is.

    ``entries``: (list_name, pattern, action 'add' or 'remove', at). An entry is
    active from an addition up to the next removal, that moment not included; a
    removal wins over an addition at the same time. Rows with a null in any
    of these columns, and other actions, are left out; repeated rows count once.
    """
    known = entries.select("list_name", "pattern", "action", "at").dropna().filter(F.col("action").isin("add", "remove"))
    moments = known.groupBy("list_name", "pattern", "at").agg(F.min(F.col("action") == "add").alias("active"))
    history = Window.partitionBy("list_name", "pattern").orderBy("at")
    changes = moments.withColumn("was", F.lag("active", 1, False).over(history)).filter("active <> was")
    return changes.withColumn("valid_to", F.lead("at").over(history)).filter("active").select(
        "list_name", "pattern", F.col("at").alias("valid_from"), "valid_to"
    )


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port and a closing dot; empty where the text is no absolute URL."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1)
    return F.regexp_replace(F.lower(host), r"\.$", "")


def patterns_of(url: Column, segments: int) -> Column:
    """What lists may name: the host, its parent domains, and host with up to ``segments`` path segments ('host/a/b')."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)", 1)
    # The rest of a long path stays in one piece.
    parts = F.filter(F.split(path, "/", segments + 1), lambda p: p != "") if segments else F.array().cast("array<string>")
    steps = F.when(F.size(parts) > 0, F.sequence(F.lit(1), F.least(F.size(parts), F.lit(segments)))).otherwise(
        F.array().cast("array<int>")
    )
    paths = F.transform(steps, lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(domains, paths)))


def evaluate(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched_at") -> DataFrame:
    """``captures`` with ``lists``, the sorted names of the lists that held an entry for the URL at fetch time, and ``n_entries``.

    Captures meet entries by equality of a pattern and are kept where the
    interval covers the fetch time. Entries are few rows for a pattern and
    captures many: only the join deals them out by pattern, and Spark splits
    the captures of a frequent one. Captures are looked up once for each URL and
    time. A null URL or time, and what is no absolute URL, is on no list. All
    columns and repeated rows of ``captures`` are kept; an empty list marks
    nothing.
    """
    active = intervals(entries)
    segments = active.select(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0
    active = active.select(
        "list_name", F.col("pattern").alias("entry"), F.col("valid_from").alias("from"), F.col("valid_to").alias("to")
    )
    distinct = captures.select(F.col(url).alias("u"), F.col(at).alias("t")).dropna().distinct()
    spread = distinct.withColumn("p", F.explode(patterns_of(F.col("u"), segments)))
    held = spread.join(
        active, (F.col("p") == F.col("entry")) & (F.col("t") >= F.col("from")) & (F.col("to").isNull() | (F.col("t") < F.col("to")))
    )
    lists, n = fresh(captures, "lists"), fresh(captures, "n_entries")
    u, t = fresh(captures, "seen_url"), fresh(captures, "seen_at")
    found = held.groupBy(F.col("u").alias(u), F.col("t").alias(t)).agg(
        F.sort_array(F.collect_set("list_name")).alias(lists), F.count(F.lit(1)).alias(n)
    )
    joined = captures.join(found, (F.col(url) == F.col(u)) & (F.col(at) == F.col(t)), "left")
    return joined.select(
        *captures.columns, F.coalesce(lists, F.array().cast("array<string>")).alias(lists),
        F.coalesce(n, F.lit(0)).cast("long").alias(n),
    )
