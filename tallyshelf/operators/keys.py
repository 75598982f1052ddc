"""Dense surrogate keys without a single-partition sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bucket"


def with_bucket(df: DataFrame, natural_key: list[str], hex_digits: int) -> DataFrame:
    """Rows with the bucket ``assign_surrogate_keys`` numbers them in: the first digits of the MD5 of their natural key."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in natural_key])
    return df.withColumn(BUCKET, F.conv(F.substring(F.md5(text), 1, hex_digits), 16, 10).cast("int"))


def assign_surrogate_keys(
    new: DataFrame, natural_key: list[str], key_name: str, start: int | DataFrame = 0,
    hex_digits: int = 3, data_type: str = "bigint",
) -> DataFrame:
    """Number the rows of ``new`` (unique on ``natural_key``) from ``start`` + 1 without gaps.

    Rows fall into ``16 ** hex_digits`` buckets by the MD5 of their natural key
    and are numbered inside the bucket; a bucket's offset is the number of rows
    in the buckets before it. Buckets depend on row content only, so a task
    that is run again after an executor loss numbers its rows the same way, and
    hashing a unique key spreads them evenly. The offsets are one row per
    bucket, which bounds both their broadcast and their running total.

    ``start`` is a number or a one-row frame with column ``max_key``.
    """
    buckets = with_bucket(new, natural_key, hex_digits)
    in_bucket = Window.partitionBy(BUCKET).orderBy(*natural_key)
    numbered = buckets.withColumn("_pos", F.row_number().over(in_bucket))
    offsets = _offsets(buckets.groupBy(BUCKET).agg(F.count("*").alias("_n")))
    out = numbered.join(F.broadcast(offsets), BUCKET)
    base = start.scalar() if isinstance(start, DataFrame) else F.lit(start)
    key = (base + F.col("_offset") + F.col("_pos")).cast(data_type).alias(key_name)
    return out.select(key, *[F.col(c) for c in new.columns])


def _offsets(counts: DataFrame) -> DataFrame:
    """Rows in the buckets before each one, of (bucket, ``_n``)."""
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(BUCKET, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))


def assign_keys_by_part(
    new: DataFrame, natural_key: list[str], key_name: str, part: Column, splits: int, start: int = 0,
    hex_digits: int = 3, data_type: str = "bigint",
) -> DataFrame:
    """The numbers of ``assign_surrogate_keys``, for rows that are then written by ``part``: dealt by it once.

    ``part`` never falls while the first column of ``natural_key`` rises, as a
    month does with the day. Inside a bucket the rows of a part then stand
    together, so its rows are numbered where the part is, from the number of
    rows before them. That number comes as one row for each bucket of a part,
    which is dealt and sorted ahead of its rows. A part goes to ``splits``
    pieces, so that a batch of one part has more than one task.
    """
    rows = with_bucket(new, natural_key, hex_digits).withColumn("_of", part)
    # A bucket is never null; saying so gives both readers of the counts the same plan, so they are dealt once.
    buckets = rows.select(BUCKET, "_of").filter(F.col(BUCKET).isNotNull()).repartition(BUCKET)
    counts = buckets.groupBy(BUCKET, "_of").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(BUCKET).orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        counts.withColumn("_earlier", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .join(F.broadcast(_offsets(counts.groupBy(BUCKET).agg(F.sum("_n").alias("_n")))), BUCKET)
        .select(BUCKET, "_of", (F.col("_offset") + F.col("_earlier")).alias("_before"))
    )
    dealt = (
        rows.withColumn("_before", F.lit(None).cast("bigint")).unionByName(heads, allowMissingColumns=True)
        .withColumn("_piece", F.pmod(F.xxhash64(BUCKET), F.lit(splits))).repartition("_of", "_piece")
    )
    place = Window.partitionBy("_of", "_piece", BUCKET).orderBy(F.col("_before").isNull(), *natural_key)
    numbered = dealt.withColumns({
        "_pos": F.row_number().over(place) - 1,
        "_first": F.first("_before").over(place.rowsBetween(Window.unboundedPreceding, 0)),
    }).filter("_before IS NULL")
    key = (F.lit(start) + F.col("_first") + F.col("_pos")).cast(data_type).alias(key_name)
    return numbered.select(key, *[F.col(c) for c in new.columns])


def assign_keys_where_dealt(
    new: DataFrame, natural_key: list[str], key_name: str, part: Column, pieces: Column, start: int = 0,
    hex_digits: int = 3, data_type: str = "bigint",
) -> DataFrame:
    """The numbers of ``assign_surrogate_keys``, for rows that are then written by a ``part`` of any order: dealt by it once.

    Only the natural keys go by bucket. Numbered there, they are dealt to the
    parts as the rows themselves are, and each row finds its number beside it.
    A part goes to ``pieces`` pieces by the first column of its natural key:
    rows that share it, as the lines of an order do, stay together, and what
    they have in common stays small on the way.
    """
    rows = new.withColumns({"_of": part, "_piece": F.pmod(F.xxhash64(natural_key[0]), pieces).cast("int")})
    keys = rows.select(*natural_key, "_of", "_piece")
    numbers = assign_surrogate_keys(keys, natural_key, "_number", start, hex_digits, data_type)
    dealt = rows.unionByName(numbers, allowMissingColumns=True).repartition("_of", "_piece")
    place = Window.partitionBy("_of", "_piece", *natural_key).orderBy(F.col("_number").isNull())
    found = F.first("_number").over(place.rowsBetween(Window.unboundedPreceding, 0))
    numbered = dealt.withColumn("_found", found).filter("_number IS NULL")
    return numbered.select(F.col("_found").alias(key_name), *[F.col(c) for c in new.columns])


def max_key(df: DataFrame, key_name: str) -> DataFrame:
    """One row holding the highest key in use, for ``start``."""
    return df.agg(F.coalesce(F.max(key_name).cast("bigint"), F.lit(0)).alias("max_key"))
