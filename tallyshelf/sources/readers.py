"""Readers for marketplace drops, catalog files and stored tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.gates import check_required_columns
from ..operators.standardize import standardize, union_marketplaces

# Error conditions Spark reports for a path that is missing or holds no Parquet file.
_ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def read_optional_source(spark: SparkSession, path: str, platform: str) -> DataFrame | None:
    """Standardized snapshots of one marketplace, or None if it delivered nothing.

    Only a missing or empty folder is skipped; an unreadable file is an error.
    """
    try:
        return standardize(spark.read.parquet(path), platform)
    except AnalysisException as error:
        if error.getCondition() in _ABSENT:
            return None
        raise


def read_available_sources(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Union of all marketplaces that delivered; an error if none did."""
    found = [read_optional_source(spark, path, platform) for platform, path in paths.items()]
    frames = [f for f in found if f is not None]
    if not frames:
        raise RuntimeError(f"no readable source among {sorted(paths)}")
    return union_marketplaces(frames)


def _file_schema(path: str) -> str | None:
    """The schema text in a Parquet file's footer; None where pyarrow can't open the path's store here."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        store, name = fs.LocalFileSystem(), "/" + rest.lstrip("/")
    else:
        try:
            store, name = fs.FileSystem.from_uri(quote(path, safe=":/@"))
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
            return None
    with store.open_input_file(name) as source:
        # The first line names the Python object, not the schema.
        return str(pq.ParquetFile(source).schema).partition("\n")[2]


def _schema_groups(spark: SparkSession, path: str) -> list[DataFrame]:
    """One frame per distinct file schema below ``path``.

    Footers are read in tasks over the listed files, so the driver starts one
    scan per schema, not per file. Only files in a store that pyarrow can't
    open have their schema read by Spark, one by one. The driver holds the file
    names, as it does for any listing.
    """

    def schemas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_file_schema(p) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(texts, pa.string())], ["path", "layout"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    layouts = files.select("path").mapInArrow(schemas, "path string, layout string")
    groups: dict[str, list[str]] = {}
    for row in layouts.collect():
        layout = row.layout or spark.read.parquet(row.path).schema.json()
        groups.setdefault(layout, []).append(row.path)
    return [spark.read.parquet(*sorted(groups[g])) for g in sorted(groups)]


def read_heterogeneous_snapshots(spark: SparkSession, path: str, platform: str) -> DataFrame:
    """Snapshots whose files have different columns or types.

    Files that differ only in which columns they have are merged in one scan.
    Conflicting types of one column cannot be merged, so then files are grouped
    by schema, each group is one scan, and the groups are united after typing.
    """
    try:
        files = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True)
        return standardize(files.parquet(path), platform)
    except Exception as error:
        if getattr(error, "getCondition", lambda: None)() in _ABSENT:
            raise
        groups = _schema_groups(spark, path)
        # With one schema the files can't be in conflict: the error is another one.
        if len(groups) < 2:
            raise
    return reduce(DataFrame.unionByName, [standardize(df, platform) for df in groups])


def read_latest_snapshot_sample(spark: SparkSession, path: str, limit: int = 100) -> DataFrame:
    """First rows of the newest file of a folder, in the order of their cells. Files are listed, not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    newest = files.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]
    rows = spark.read.parquet(newest)
    return rows.orderBy(*rows.columns).limit(limit)


def read_gz_jsonl_typed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, plain or gzipped. A gzip file is one task: deliver many files, not one big one."""
    return spark.read.schema(schema).json(path)


def read_multiline_json_products(
    spark: SparkSession, path: str, schema: str | None = None, array: str = "products"
) -> DataFrame:
    """JSON documents holding an array of products, one row per product."""
    reader = spark.read.option("multiLine", True)
    documents = (reader.schema(schema) if schema else reader).json(path)
    rest = [c for c in documents.columns if c != array]
    item = documents.withColumn("_file", F.input_file_name()).select(
        F.col("_file").alias("snapshot"), *[F.col(f"`{c}`").alias(f"document_{c}") for c in rest],
        F.explode(array).alias("_item"),
    )
    return item.select("snapshot", *[f"document_{c}" for c in rest], "_item.*")


def read_json_inferred(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def read_csv_strict(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """Quoted, multi-line CSV with a header; a malformed row or missing column is an error."""
    df = (
        spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
        .option("encoding", "UTF-8").option("mode", "FAILFAST").csv(path)
    )
    return check_required_columns(df, required)


def read_partition_with_base(spark: SparkSession, base: str, partition: str) -> DataFrame:
    """One hive partition, with its partition column."""
    return spark.read.option("basePath", base).parquet(f"{base.rstrip('/')}/{partition}")


def read_parquet_glob(spark: SparkSession, *globs: str) -> DataFrame:
    return spark.read.parquet(*globs)


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, columns: list[str], partition_column: str | None = None,
    lower: int = 0, upper: int = 0, partitions: int = 1, **options: str,
) -> DataFrame:
    """Warehouse table in a database, read in parallel ranges of ``partition_column``."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column).option("lowerBound", lower)
            .option("upperBound", upper).option("numPartitions", partitions)
        )
    return reader.load().select(*columns)


def list_unprepared_snapshots(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Input paths whose file stem has no output folder yet."""

    def stem(c):
        return F.regexp_replace(F.regexp_extract(c, r"([^/]+)/*$", 1), r"\.[^.]*$", "")

    done = outputs.select(stem(F.col("path")).alias("stem"))
    return inputs.withColumn("stem", stem(F.col("path"))).join(done, "stem", "left_anti").select("path")
