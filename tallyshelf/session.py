"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_SETTINGS = {
    # Timestamps are UTC everywhere; a local zone would move snapshot days.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where the step after it then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods above 8000 bytes of bytecode. Cleaning is
    # one wide projection: past that size separate, smaller methods run about
    # three times as fast as one fused method that stays interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
# Settings that also hold for a session made elsewhere.
_PINNED = [
    "spark.sql.session.timeZone", "spark.sql.adaptive.forceOptimizeSkewedJoin", "spark.sql.codegen.hugeMethodLimit",
]


def build_session(app_name: str = "tallyshelf", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings the jobs rely on; shuffle sizing is left to AQE."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings results and speed depend on to a session made elsewhere."""
    for key in _PINNED:
        spark.conf.set(key, _SETTINGS[key])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; a cluster
    without it is an error, because a machine-local folder would be lost with
    its executor.
    """
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tallyshelf-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextmanager
def set_for(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings (dots as ``__``) that hold inside and are put back."""
    before = {key: spark.conf.get(key, None) for key in (name.replace("__", ".") for name in values)}
    try:
        for key, value in zip(before, values.values()):
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shuffles_freed(spark: SparkSession):
    """What runs inside leaves no shuffle files: Spark removes them as it ends, not when the driver happens to collect its garbage.

    For writes and for frames made inside and run once: one that runs again has to make its shuffles anew.
    """
    return set_for(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


# Bytes of a stored input for each partition of a shuffle of it: decoded rows are some thirty times as large.
INPUT_A_PARTITION = 4 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def size_shuffles(spark: SparkSession, path: str) -> None:
    """Let shuffles start with partitions in proportion to an input, so that a task sorts its rows without spilling; AQE joins small ones."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    spark.conf.set(_INITIAL, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // INPUT_A_PARTITION)))


def partitions(spark: SparkSession) -> int:
    """Partitions a shuffle starts with."""
    default = spark.conf.get("spark.sql.shuffle.partitions")
    return max(int(default), int(spark.conf.get(_INITIAL, default)))
