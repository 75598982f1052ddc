"""Incremental versions of the batch jobs on Structured Streaming.

Every job processes what is available and stops (``availableNow``); run it
again, or change the trigger, to go on. Checkpoints and outputs are paths on
the shared file system.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import dedupe
from ..operators.standardize import filter_valid_core, standardize
from ..plans import warehouse as W
from . import tables


def _run(writer) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


def incremental_snapshot_ingest(spark: SparkSession, source: str, out: str, checkpoint: str, platform: str) -> None:
    """Standardize each new snapshot file exactly once."""
    schema = spark.read.parquet(source).schema
    rows = filter_valid_core(standardize(spark.readStream.schema(schema).parquet(source), platform))
    _run(rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint))


def stream_first_seen_dedup(
    stream: DataFrame, key: str, out: str, checkpoint: str, event_time: str | None = None, horizon: str = "7 days",
    order: list[str] | None = None,
) -> None:
    """Items whose id no earlier page had; with ``event_time`` in bounded-state mode: an id older than ``horizon`` may come again.

    Without it, the default, the ids seen are those stored in ``out``, which
    lies in parts by a hash of the id: a batch picks its first row of each id
    (by ``order``, then by all columns) and adds those not stored. No state is
    kept between batches, so memory does not grow with the ids ever seen.
    """
    if event_time:
        first = stream.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark([key])
        _run(first.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint))
        return

    def store(batch: DataFrame, n: int) -> None:
        tables.append_new(dedupe.pick_first(batch, [key], [F.col(c).asc_nulls_last() for c in order or []]), out, key)

    _run(stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint))


def write_batch(batch: DataFrame, batch_id: int, out: str) -> None:
    """A batch under its own number: writing it again replaces it."""
    batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")


def stream_idempotent_page_sink(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Page rows are stored before the checkpoint moves, so a replayed batch does not repeat them."""
    _run(
        stream.writeStream.foreachBatch(lambda batch, n: write_batch(batch, n, out))
        .option("checkpointLocation", checkpoint)
    )


# Fixed value: the search serves no offset beyond it.
LAST_OFFSET = 12_000


def stream_keyword_progress(
    pages: DataFrame, out: str, checkpoint: str, page_size: int, last_offset: int = LAST_OFFSET
) -> DataFrame:
    """Per keyword the next offset to fetch and whether it is done.

    ``pages`` holds (keyword, offset, results, total, fetched_at, event_id). The
    next offset lies behind the newest page's results. A keyword is done with an
    empty or short page, past ``last_offset``, or when its total is reached.

    ``out`` holds one row per keyword, that of its newest page; a batch
    overwrites the parts its keywords lie in. Reading the result takes as long as
    there are keywords, however many batches came, and a page that comes again
    changes nothing.
    """
    next_offset = F.col("offset") + F.col("results")
    done = (
        (F.col("results") == 0) | (F.col("results") < page_size) | (next_offset > last_offset)
        | F.coalesce(next_offset >= F.col("total"), F.lit(False))
    )
    rows = pages.select(
        "keyword", next_offset.alias("next_offset"), done.alias("completed"), F.col("fetched_at").alias("updated_at"), "event_id"
    )
    newest = F.struct("updated_at", "event_id")

    def latest(found: DataFrame) -> DataFrame:
        return found.groupBy("keyword", *[c for c in found.columns if c == tables.PART]).agg(F.max_by(
            F.struct("next_offset", "completed", "updated_at", "event_id"), newest).alias("_page")).select(
            *[c for c in found.columns if c == tables.PART], "keyword", "_page.*")

    def store(batch: DataFrame, n: int) -> None:
        tables.merge_batch(latest(batch), n, out, f"{checkpoint}/ahead", "keyword", latest)

    _run(rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint))
    return tables.current(pages.sparkSession, out, rows.schema).drop(tables.PART, "event_id")


_METRICS = "day date, http_attempts bigint, http_429 bigint, late_rows bigint, newest timestamp"


def stream_daily_metrics(metrics: DataFrame, out: str, checkpoint: str, delay: str = "2 days") -> DataFrame:
    """Attempts and refused requests per UTC day, however late a row comes.

    ``out`` holds one row per day. A day is closed once its end lies ``delay``
    behind the newest row seen; rows that come after that are merged into it
    like any other and counted in ``late_rows`` besides. The watermark lies in
    the table (``newest``), not in the state store, so no row is ever dropped.
    Each batch is merged once, also when it is replayed.
    """
    spark = metrics.sparkSession
    schema = T._parse_datatype_string(_METRICS)
    sums = [F.sum(c).alias(c) for c in ("http_attempts", "http_429", "late_rows")]

    def closing_line() -> datetime | None:
        return tables.current(spark, out, schema).agg(F.max("newest") - F.expr(f"INTERVAL {delay}")).first()[0]

    def add_up(rows: DataFrame) -> DataFrame:
        return rows.groupBy("day", tables.PART).agg(*sums, F.max("newest").alias("newest"))

    def store(batch: DataFrame, n: int) -> None:
        late = F.coalesce(F.date_add(F.to_date("recorded_at"), 1) <= F.lit(closing_line()).cast("timestamp"), F.lit(False))
        per_day = batch.groupBy(F.to_date("recorded_at").alias("day")).agg(
            F.sum("http_attempts").alias("http_attempts"), F.sum("http_429").alias("http_429"),
            F.sum(late.cast("bigint")).alias("late_rows"), F.max("recorded_at").alias("newest"),
        )
        tables.merge_batch(per_day, n, out, f"{checkpoint}/ahead", "day", add_up)

    _run(metrics.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint))
    days = tables.current(spark, out, schema).drop(tables.PART)
    return days.withColumn("closed", F.date_add("day", 1) <= F.lit(closing_line()).cast("timestamp"))


def stream_fact_load(
    stream: DataFrame, warehouse: W.Warehouse, checkpoint: str, name: str, policy: str = "insert"
) -> None:
    """Processed snapshots into the warehouse, one load per micro-batch.

    Each load is published with the batch number; a replay of a batch up to
    the last published one is skipped. A late snapshot is stored under its own day.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= warehouse.head()["batches"].get(name, -1):
            return
        rows = dedupe.dedupe_daily_snapshot(batch).persist()  # a load reads its input once per table
        W.load_fact_external(warehouse, rows, batch=(name, batch_id), policy=policy)
        rows.unpersist()

    _run(stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint))
