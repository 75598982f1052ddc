"""Tables that micro-batches keep current: rows lie in folders by a hash of their key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "key_part"
PARTS = 32


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def part_of(*key: str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(PARTS)).cast("int")


def parts_in(rows: DataFrame) -> list[int]:
    """The parts that hold a row, at most ``PARTS``."""
    return [r[0] for r in rows.select(PART).distinct().collect()]


def current(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a table with the part they lie in; none before its first batch."""
    schema = T.StructType([f for f in schema if f.name != PART] + [T.StructField(PART, T.IntegerType())])
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def append_new(batch: DataFrame, path: str, key: str) -> None:
    """Add the rows whose key the table doesn't hold; ``batch`` has one row per key.

    Stored keys are read from the parts the batch touches, their column alone.
    A batch repeated after it was written in part adds what is missing.
    """
    spark = batch.sparkSession
    rows = batch.withColumn(PART, part_of(key)).persist()
    stored = current(spark, path, rows.schema).filter(F.col(PART).isin(parts_in(rows))).select(
        F.col(key).alias("_seen"), F.col(PART).alias("_part"))
    new = rows.join(stored, (F.col(PART) == F.col("_part")) & F.col(key).eqNullSafe(F.col("_seen")), "left_anti")
    new.hint("rebalance", F.col(PART)).write.partitionBy(PART).mode("append").parquet(path)
    rows.unpersist()


def merge_batch(
    batch: DataFrame, number: int, path: str, ahead: str, key: str, merge: Callable[[DataFrame], DataFrame]
) -> None:
    """Bring a micro-batch into the table at ``path``.

    ``batch`` has the table's columns; ``merge`` makes one row per key out of
    stored and new ones and keeps the part column. Only the parts that hold a
    key of the batch are read and overwritten.

    What these parts will hold is written in full below ``ahead``, under the
    batch's number, before the table is touched. A run cut off at any point is
    repeated from there, so nothing is merged twice and no part is lost.
    ``ahead`` belongs to the stream's checkpoint and holds the last batch only.
    """
    spark = batch.sparkSession
    whole = f"{ahead}/{number}"
    rows = batch.withColumn(PART, part_of(key))
    schema = rows.schema
    if not exists(spark, f"{whole}/_SUCCESS"):
        rows = rows.persist()
        stored = current(spark, path, schema).filter(F.col(PART).isin(parts_in(rows)))
        merge(stored.unionByName(rows)).write.mode("overwrite").parquet(whole)
        rows.unpersist()
    spark.read.schema(schema).parquet(whole).hint("rebalance", F.col(PART)).write.partitionBy(PART).mode(
        "overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    remove(spark, f"{ahead}/{number - 1}")
