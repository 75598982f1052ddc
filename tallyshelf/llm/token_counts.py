"""Token counts with a digest cache."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import shared_path, stored

_COUNTS = "digest binary, n_tokens long"
_CACHE = f"{_COUNTS}, tokenizer string"


def read_cache(docs: DataFrame, cache: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version; a missing or empty folder is an empty cache.

    Two runs may have appended the same digest; it counts once.
    """
    spark = docs.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], _COUNTS)
    rows = spark.read.schema(_CACHE).parquet(cache).filter(F.col("tokenizer") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, cache: str, tokenizer: str, limit: int = 1024) -> DataFrame:
    """Tokens of every whole text: (doc_id, n_bytes, n_tokens, over_limit).

    ``cache`` is a shared folder of (content digest, tokenizer version, count).
    Content is normalised only where that can't change a count: a null text is
    the empty text. Digests are grouped without their texts; a distinct digest
    that the cache lacks is encoded from one document that holds it and
    appended. Only those texts are moved, and none where the misses are few
    enough for Spark to broadcast. No begin, end or added special tokens, no
    truncation. Null doc_ids, repeated doc_ids and repeated rows each keep
    their row; other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.unhex(F.sha2(text, 256))
    version = tokens.version(tokenizer)
    keyed = stored(
        docs.select("doc_id", digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes")), "digests"
    )
    wanted = keyed.groupBy("digest").agg(F.min("doc_id").alias("holder"))
    missing = wanted.join(read_cache(docs, cache, version), "digest", "left_anti")
    held = docs.select(F.col("doc_id").alias("holder_id"), digest.alias("held"), text.alias("text"))
    # min() is null only where every doc_id is: <=> also finds that holder.
    texts = held.join(missing, F.col("holder_id").eqNullSafe(F.col("holder")) & (F.col("held") == F.col("digest")))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = tokens.load(tokenizer).ids
        for batch in batches:
            n = [len(ids(t.as_py())) // 4 for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    # Repeated rows of one holder are encoded again but stored once.
    new = texts.select("digest", "text").mapInArrow(counted, _COUNTS)
    new.withColumn("tokenizer", F.lit(version)).write.mode("append").parquet(cache)
    return keyed.join(read_cache(docs, cache, version), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def new_cache(docs: DataFrame) -> str:
    """Folder of a cache that starts empty."""
    return shared_path(docs.sparkSession, "token-cache")
