"""Helpers the operators share: written tables, gapless numbers, components."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..session import set_for, shared_dir, shuffles_freed


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new folder name below the one every executor can reach."""
    return f"{shared_dir(spark)}/llm/{tag}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


# Folders written by the operators that run just now, the innermost last.
_STEPS: ContextVar[tuple[list[str], ...]] = ContextVar("steps", default=())


@contextmanager
def steps(spark: SparkSession) -> Iterator[None]:
    """Tables that ``stored`` writes inside are removed at the end, but results, which go by the operator around this one."""
    mine: list[str] = []
    token = _STEPS.set((*_STEPS.get(), mine))
    try:
        yield
    finally:
        _STEPS.reset(token)
        for path in mine:
            remove(spark, path)


def stored(df: DataFrame, tag: str = "step", result: int = 0, path: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read from there: later steps start from the files, not from its lineage.

    Its shuffles are freed once it stands. Inside ``steps`` it is kept to their end, or as the ``result`` of so many of the
    operators around it beyond that.
    """
    spark, opened = df.sparkSession, _STEPS.get()
    path = path or shared_path(spark, tag)
    if len(opened) > result:
        opened[-1 - result].append(path)
    # The driver keeps a text of every plan it ran: short ones here, where plans are many.
    with shuffles_freed(spark), set_for(spark, spark__sql__maxPlanStringLength="4096"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lean(spark: SparkSession) -> None:
    """A worker keeps the memory of its largest batch of texts: small ones."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def text_key(text: Column | str) -> Column:
    """128-bit digest of a text; null for null."""
    return F.unhex(F.md5(text))


def fresh(df: DataFrame, base: str) -> str:
    """A column name ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str, rows: int) -> DataFrame:
    """Add ``name``: numbers from 0 without gaps among the rows that agree on ``keys`` (never null).

    A key's rows are spread over about sqrt(rows) buckets by a hash of ``order``,
    numbered inside a bucket, and shifted by the rows in the buckets before it.
    So neither a hot key nor the running totals gather in one task. Rows that
    agree on ``order`` may share numbers in any way; give all columns that tell
    rows apart, then a task run again numbers its rows the same.
    """
    bucket, place, start, size = "_nb_bucket", "_nb_place", "_nb_start", "_nb_size"
    spread = df.withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(max(1, math.isqrt(rows)))))
    sizes = spread.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias(size))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, bucket, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(start))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    return (
        spread.withColumn(place, F.row_number().over(inside) - 1)
        .join(starts, [*keys, bucket])
        .withColumn(name, (F.col(start) + F.col(place)).cast("long"))
        .drop(bucket, place, start)
    )


def salted_key(column: Column | str, salts: int) -> Column:
    """A salt below ``salts`` from a column that spreads well."""
    return F.pmod(F.xxhash64(column), F.lit(salts)).cast("int")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The smallest id each linked id can reach: (node, root), both long.

    Alternating large-star and small-star steps: every step replaces links by
    links to smaller ids, so the table stays as long as the link list, and a
    few rounds reach one star per component. Minima are aggregated map-side and
    joined back, so a node with very many links is not gathered in a task. Each
    round is written to the shared folder and starts from there.
    """
    lean(edges.sparkSession)

    def written(df: DataFrame) -> tuple[DataFrame, tuple]:
        # Seen as the links are written: how many there are, and a sum that tells one list from another.
        seen = Observation()
        out = stored(df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")), "links")
        return out, (seen.get["n"], seen.get["s"])

    links, now = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    seen = None
    while now != seen:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # Small star: neighbours are the smaller side of each link already.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        seen = now
        links, now = written(small.filter("u <> v").distinct())
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))


def members(found: DataFrame) -> DataFrame:
    """(region, node): the components of ``components``, their roots among the nodes."""
    return found.select(F.col("root").alias("region"), "node").unionByName(
        found.select(F.col("root").alias("region"), F.col("root").alias("node")).distinct()
    )
