"""The warehouse as plain Parquet tables, and its idempotent loads.

Layout below ``root``::

    <table>/                      facts by calendar month, product and customer
                                  dimensions by a hash of their natural key
    sales_month/                  the month each sale is stored in, by a hash of its key
    log/                          a row when a load starts to write, one when it is through
    scratch/<load>/               steps of a running load, removed at its end

A load works on scratch tables and writes when all of them stand: dimensions
first, facts last, new rows appended, touched parts and months overwritten by
Spark's dynamic partition overwrite. A load that fails before that leaves
nothing; one that is cut off while it writes is repeated, which adds what is
missing, as no load adds a row twice. Only the touched months and parts are read
and written, never the whole history.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import columns as C
from ..operators import dedupe, joins
from ..operators.gates import GateError
from ..operators.keys import assign_keys_by_part, assign_keys_where_dealt, assign_surrogate_keys
from ..operators.standardize import filter_catalog_dim, filter_loadable
from ..session import partitions, shuffles_freed

_PART = "_part"
# Parts of a dimension, and of the months by sale.
PARTS = 32
_KEYS = {
    "dim_platform": "platform_key", "dim_product": "product_key", "dim_customer": "customer_key",
    "fact_sales": "sales_key", "fact_external_product": "external_fact_key",
}
# Facts are many: more buckets, so that none gets large.
_KEY_HEX_DIGITS = {"fact_sales": 4, "fact_external_product": 4}
_MONTHS = "sales_month"
# Tables and steps are written in bulk and read a few times: smaller files are worth the slower codec.
CODEC = "zstd"
_SCHEMAS = {**S.WAREHOUSE, _MONTHS: T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("product_key", T.LongType()), T.StructField("month", T.IntegerType()),
])}
_LOG = "version long, done boolean, keys map<string,bigint>, batches map<string,bigint>"
_ORDER = ["dim_date", "dim_platform", "dim_product", "dim_customer", _MONTHS, "fact_sales", "fact_external_product"]


def month_of(day: str = "date_key") -> Column:
    return F.floor(F.col(day) / 100).cast("int")


# What a batch of snapshots lies in buckets by.
BATCH_KEY = ["platform", "external_product_id"]


def part_of(*key: str) -> Column:
    """The part of a table that holds a natural key."""
    return F.pmod(F.xxhash64(*key), F.lit(PARTS)).cast("int")


# What a table's rows are dealt to folders by; other tables are small and lie in one.
_PARTED = {
    "dim_product": lambda: part_of(*S.PRODUCT_KEY), "dim_customer": lambda: part_of("source_customer_id"),
    _MONTHS: lambda: part_of(*S.SALES_KEY), "fact_sales": month_of, "fact_external_product": month_of,
}


def in_buckets(
    df: DataFrame, keys: list[str], name: str, path: str, then: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Table ``name`` below ``path``, dealt to buckets by ``keys``; ``then`` works on the dealt rows, before they are written."""
    n = partitions(df.sparkSession)
    dealt = df.repartition(n, *keys)
    with shuffles_freed(df.sparkSession):
        (then(dealt) if then else dealt).write.format("parquet").mode("overwrite").option("path", path).option(
            "compression", CODEC).bucketBy(n, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


class Warehouse:
    """Tables of one warehouse root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def head(self) -> dict:
        """Version, whether its load is through, last key per table, last batch per stream: of the newest rows of the log."""
        newest = self._stored(f"{self.root}/log", T._parse_datatype_string(_LOG)).orderBy(
            F.desc("version"), F.desc("done")).first()
        if newest is None:
            return {"version": 0, "done": True, "keys": {}, "batches": {}}
        return {"version": newest["version"], "done": newest["done"], "keys": dict(newest["keys"]), "batches": dict(newest["batches"])}

    def log(self, version: int, done: bool, keys: dict, batches: dict) -> None:
        row = self.spark.createDataFrame([(version, done, keys, batches)], _LOG)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/log")

    def read(self, table: str, columns: list[str] | None = None, months: list[int] | None = None) -> DataFrame:
        """Stored table; only the wanted columns and months (or parts) are read."""
        df = self.parts(table, months).drop(_PART)
        return df.select(*columns) if columns else df

    def frames(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in S.WAREHOUSE}

    def parts(self, table: str, parts: list[int] | None = None) -> DataFrame:
        """Stored rows with the folder they lie in."""
        schema = T.StructType([*_SCHEMAS[table], T.StructField(_PART, T.IntegerType())])
        df = self._stored(f"{self.root}/{table}", schema if table in _PARTED else _SCHEMAS[table])
        if table not in _PARTED:
            return df.withColumn(_PART, F.lit(0))
        return df if parts is None else df.filter(F.col(_PART).isin(*parts))

    def _stored(self, path: str, schema: T.StructType) -> DataFrame:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.read.schema(schema).parquet(path)
        # Known to be empty when planned: joins with it, and their shuffles, fall away.
        return self.spark.createDataFrame([], schema).filter(F.lit(False))

    @contextmanager
    def publish(self, batch: tuple[str, int] | None = None):
        """A load: what it adds is written when it is complete, or not at all. ``batch``: a stream's name and batch number."""
        load = Load(self, batch)
        try:
            yield load
            load.commit()
        finally:
            load.drop_scratch()


class Load:
    """Changes of one load. Reads see what the load itself has staged."""

    def __init__(self, warehouse: Warehouse, batch: tuple[str, int] | None):
        self.wh, self.spark = warehouse, warehouse.spark
        head = warehouse.head()
        self.base_version, self.batches = head["version"], {**head["batches"], **(dict([batch]) if batch else {})}
        # After a load that was cut off while it wrote, its keys are looked up in the tables.
        self.keys = head["keys"] if head["done"] else self._highest()
        self.staged: dict[str, list[DataFrame]] = {}
        self.replaced: dict[str, set[int]] = {}
        self.last: list[tuple] = []
        self.changed = batch is not None
        self._scratch, self._names = f"{warehouse.root}/scratch/{uuid.uuid4().hex}", []

    def _highest(self) -> dict:
        found = {t: self.wh.read(t, [key]).agg(F.max(key)).first()[0] for t, key in _KEYS.items()}
        return {t: int(k) for t, k in found.items() if k is not None}

    def parts(self, table: str, parts: list[int] | None = None) -> DataFrame:
        df = self.wh.parts(table, parts)
        if self.replaced.get(table):
            df = df.filter(~F.col(_PART).isin(*self.replaced[table]))
        for more in self.staged.get(table, []):
            df = df.unionByName(more if parts is None or table not in _PARTED else more.filter(F.col(_PART).isin(*parts)))
        return df

    def read(self, table: str, columns: list[str] | None = None, months: list[int] | None = None) -> DataFrame:
        df = self.parts(table, months).drop(_PART)
        return df.select(*columns) if columns else df

    def scratch(self, df: DataFrame) -> DataFrame:
        """Write an intermediate result and go on from the written table, until the load ends."""
        path = f"{self._scratch}/{uuid.uuid4().hex}"
        with shuffles_freed(self.spark):
            df.write.parquet(path, compression=CODEC)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, keys: list[str], then: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """``scratch`` in buckets by ``keys``: joins, windows and groups on them (or more) need no further shuffle of it.

        ``then`` is applied to the rows once they are dealt, before they are written.
        """
        name = f"load_{uuid.uuid4().hex}"
        self._names.append(name)
        return in_buckets(df, keys, name, f"{self._scratch}/{name}", then)

    def drop_scratch(self) -> None:
        for name in self._names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._remove(self._scratch)

    def _remove(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def number(self, table: str, rows: DataFrame, natural_key: list[str]) -> DataFrame:
        """Rows with the table's next surrogate keys and in its column order."""
        key, schema = _KEYS[table], S.WAREHOUSE[table]
        return assign_surrogate_keys(
            rows, natural_key, key, self.keys.get(table, 0), _KEY_HEX_DIGITS.get(table, 3),
            schema[key].dataType.simpleString(),
        )

    def numbered_merge(self, table: str, stored: DataFrame, source: DataFrame, natural_key: list[str], set_columns: list[str]) -> DataFrame:
        """``merged`` facts, the new ones numbered, with ``_is_new`` and the month they go to. The join is written first, so its shuffles are gone when rows are dealt on."""
        rows = self.scratch(merged(stored, source, natural_key, set_columns))
        columns = [*S.WAREHOUSE[table].fieldNames(), "_is_new"]
        new = self.number(table, rows.filter("_is_new").drop(_KEYS[table]), natural_key)
        return rows.filter("NOT _is_new").select(*columns).unionByName(new.select(*columns)).withColumn(_PART, month_of())

    def number_by_month(self, table: str, rows: DataFrame, natural_key: list[str], months: int) -> DataFrame:
        """``number`` for facts whose key begins with the day, dealt by month: written as they are, they need no further shuffle."""
        key, schema = _KEYS[table], S.WAREHOUSE[table]
        return assign_keys_by_part(
            rows, natural_key, key, month_of(), -(-partitions(self.spark) // max(1, months)), self.keys.get(table, 0),
            _KEY_HEX_DIGITS[table], schema[key].dataType.simpleString(),
        )

    def number_in_months(self, table: str, rows: DataFrame, natural_key: list[str], sizes: dict[int, int]) -> DataFrame:
        """``number`` for facts whose key says nothing of the day, dealt by month; ``sizes``: rows of each month, which set its share of tasks."""
        key, schema, n = _KEYS[table], S.WAREHOUSE[table], partitions(self.spark)
        share = {m: -(-n * size // max(1, sum(sizes.values()))) for m, size in sizes.items()}
        split = F.create_map(*[F.lit(v) for m, pieces in share.items() if pieces > 1 for v in (m, pieces)]) if max(share.values()) > 1 else None
        pieces = F.lit(1) if split is None else F.coalesce(split[month_of()], F.lit(1))
        return assign_keys_where_dealt(
            rows, natural_key, key, month_of(), pieces, self.keys.get(table, 0), _KEY_HEX_DIGITS[table],
            schema[key].dataType.simpleString(),
        )

    def append(self, table: str, rows: DataFrame) -> int:
        """Add rows; returns how many."""
        out, seen = _observed(table, rows)
        self.staged.setdefault(table, []).append(self.scratch(out))
        return self._count(table, seen.get)

    def replace(self, table: str, rows: DataFrame, parts: list[int]) -> int:
        """Rewrite parts of a table; ``rows`` is then all there is in them."""
        out, seen = _observed(table, rows)
        new = self.scratch(out)
        self.staged[table] = [df.filter(~F.col(_PART).isin(*parts)) for df in self.staged.get(table, [])] + [new]
        self.replaced.setdefault(table, set()).update(parts)
        self.changed = True
        return self._count(table, seen.get)

    def at_last(self, table: str, rows: DataFrame, months: list[int] | None, told: Callable[[int], None], counted: Column | None = None, dealt: bool = False) -> None:
        """Facts that go straight into their table at the load's end, over ``months`` or beside what is there.

        ``told`` gets the number of rows (of those that ``counted`` says). ``dealt``: the rows come dealt by month.
        """
        self.last.append((table, rows, months, told, counted, dealt))

    def _count(self, table: str, seen: dict) -> int:
        n, top = seen.get("n") or 0, seen.get("top")
        self.changed |= n > 0
        if top is not None:
            self.keys[table] = max(self.keys.get(table, 0), int(top))
        return n

    def commit(self) -> None:
        if not (self.changed or self.last):
            return
        if self.wh.head()["version"] != self.base_version:
            raise GateError("another load was published meanwhile; run this one again")
        version, keys = self.base_version + 1, dict(self.keys)
        self.wh.log(version, False, keys, self.batches if self.base_version else {})
        with shuffles_freed(self.spark):
            self._write_all()
        self.wh.log(version, True, self.keys, self.batches)

    def _write_all(self) -> None:
        for table in [t for t in _ORDER if t in self.staged]:
            rows = self.staged[table][0]
            for more in self.staged[table][1:]:
                rows = rows.unionByName(more)
            over = sorted(self.replaced.get(table, ()))
            if over:
                self._write(table, rows.filter(F.col(_PART).isin(*over)), over)
                rows = rows.filter(~F.col(_PART).isin(*over))
            self._write(table, rows)
        for table, rows, months, told, counted, dealt in self.last:
            out, seen = _observed(table, rows, counted)
            self._write(table, out, months, dealt)
            told(self._count(table, seen.get))

    def _write(self, table: str, rows: DataFrame, over: list[int] | None = None, dealt: bool = False) -> None:
        path = f"{self.wh.root}/{table}"
        if table not in _PARTED:
            rows.drop(_PART).write.mode("append").parquet(path, compression=CODEC)
            return
        # Rebalancing brings a folder's rows together, splits a large one and joins small ones by size, without a sampling run before.
        writer = (rows if dealt else rows.hint("rebalance", F.col(_PART))).write.option("compression", CODEC).partitionBy(_PART)
        if over is None:
            writer.mode("append").parquet(path)
            return
        seen = Observation()
        rows.observe(seen, F.collect_set(_PART).alias("parts")).hint("rebalance", F.col(_PART)).write.partitionBy(_PART).mode(
            "overwrite").option("partitionOverwriteMode", "dynamic").parquet(path, compression=CODEC)
        # Overwriting leaves folders that got no rows; all of their rows have moved elsewhere.
        for part in set(over) - set(seen.get.get("parts") or []):
            self._remove(f"{path}/{_PART}={part}")


def _observed(table: str, rows: DataFrame, counted: Column | None = None) -> tuple[DataFrame, Observation]:
    """``rows`` in the table's columns and folders; how many there are and their highest key are known once they are written."""
    seen, key = Observation(), _KEYS.get(table)
    cells = [_cell(rows, f).alias(f.name) for f in _SCHEMAS[table]]
    extra = [counted.alias("_counted")] if counted is not None else []
    out = rows.select(*cells, *extra)
    out = out.withColumn(_PART, _PARTED[table]() if table in _PARTED else F.lit(0))
    n = F.count_if("_counted") if extra else F.count(F.lit(1))
    top = F.max(key).cast("long") if key else F.lit(None).cast("long")
    return out.observe(seen, n.alias("n"), F.max(top if not key else F.col(key).cast("long")).alias("top")).drop("_counted"), seen


def _cell(df: DataFrame, field) -> Column:
    return (F.col(field.name) if field.name in df.columns else F.lit(None)).cast(field.dataType)


# --- maintenance operators ----------------------------------------------------------


def insert_ignore(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the target does not have."""
    return joins.missing_from(rows, target, keys)


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], set_columns: list[str], stamp: str | None = None,
    at: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(target with matched rows updated, source rows to insert).

    ``source`` is unique on ``keys``. Only ``set_columns`` are overwritten and
    ``stamp`` is set on matched rows; surrogate keys and other columns stay.
    """
    at = F.current_timestamp() if at is None else at
    new = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in set_columns], F.lit(True).alias("_hit"))
    joined = target.join(new, keys, "left")
    cells = {c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in set_columns}
    if stamp:
        cells[stamp] = F.when(F.col("_hit"), at).otherwise(F.col(stamp))
    updated = joined.select(*[cells.get(c, F.col(c)).alias(c) for c in target.columns])
    return updated, joins.missing_from(source, target, keys)


def merged(target: DataFrame, source: DataFrame, keys: list[str], set_columns: list[str]) -> DataFrame:
    """``upsert`` as one table, for large ones: both sides are dealt once. Target columns, and ``_is_new`` for rows to insert.

    New rows have the cells that ``source`` names; others, as their surrogate key, are NULL.
    """
    cells = [c for c in source.columns if c not in keys]
    new = source.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in cells], F.lit(True).alias("_hit"))
    both = target.withColumn("_held", F.lit(True)).join(new, keys, "full_outer")
    held, hit = F.col("_held").isNotNull(), F.col("_hit").isNotNull()

    def cell(f: T.StructField) -> Column:
        if f.name in keys:
            return F.col(f.name)
        given = (F.col(f"_new_{f.name}") if f.name in cells else F.lit(None)).cast(f.dataType)
        return F.when(~held | (hit & F.lit(f.name in set_columns)), given).otherwise(F.col(f.name)).alias(f.name)

    return both.select(*[cell(f) for f in target.schema], (~held).alias("_is_new"))


def seed_platforms(dim_platform: DataFrame) -> DataFrame:
    """Default platform rows the dimension lacks, in key order."""
    seeds = dim_platform.sparkSession.createDataFrame(
        [(i, *row) for i, row in enumerate(S.DEFAULT_PLATFORMS, 1)],
        "seed_no int, platform_name string, platform_type string",
    )
    return insert_ignore(dim_platform, seeds, ["platform_name"])


def weekday_style_checks(dim_date: DataFrame) -> DataFrame:
    """Row counts behind ``detect_weekday_style``, in one pass."""
    day, weekday = F.col("full_date"), F.col("day_of_week")
    iso, sunday0 = weekday == C.iso_weekday(day), weekday == C.sunday_zero_weekday(day)
    return dim_date.agg(
        F.count_if(day.isNull()).alias("null_dates"),
        F.count_if(F.col("date_key") != C.date_key(day)).alias("bad_keys"),
        F.count_if(iso & ~sunday0).alias("iso_only"),
        F.count_if(sunday0 & ~iso).alias("sunday0_only"),
        F.count_if(~iso & ~sunday0).alias("unknown"),
        # Days on which both conventions agree count for ISO, as the first test.
        F.count_if(iso & sunday0).alias("either"),
    )


def detect_weekday_style(dim_date: DataFrame) -> str:
    """``iso`` or ``sunday0`` from the stored rows; ISO if they cannot tell."""
    found = weekday_style_checks(dim_date).first()
    if found.null_dates:
        raise GateError("dim_date holds a NULL full_date")
    if found.bad_keys:
        raise GateError("dim_date keys are not yyyymmdd")
    if found.unknown:
        raise GateError("unknown day_of_week convention in dim_date")
    if found.iso_only and found.sunday0_only:
        raise GateError("mixed day_of_week conventions in dim_date")
    return "sunday0" if found.sunday0_only else "iso"


def build_dim_date(days: DataFrame, dim_date: DataFrame, style: str = "iso") -> DataFrame:
    """Calendar rows for days (column ``full_date``) the dimension lacks."""
    return joins.missing_dates(days, dim_date).select(*C.date_attributes(F.col("full_date"), style))


# --- loads ----------------------------------------------------------------------------


def _gate_zero(df: DataFrame, message: str) -> None:
    with shuffles_freed(df.sparkSession):
        n = df.count()
    if n:
        raise GateError(f"{message}: {n} rows")


def stage_records(raw: DataFrame, source_label: str) -> DataFrame:
    """Cleaned single-source rows as staged before a merge: typed, named, newest per product and day."""
    collected = C.to_utc_naive(F.col("collected_at"))
    pid = C.strip_whitespace(F.col("external_product_id"))
    rows = raw.select(
        pid.alias("external_product_id"),
        C.fallback_product_name(F.col("product_name"), pid, source_label).alias("product_name"),
        "currency", C.bound_price(F.col("price").try_cast("double")).alias("price"), "product_url",
        collected.alias("collected_at"), F.to_date(collected).alias("full_date"),
    )
    return dedupe.dedupe_daily_keep_last(rows.filter("external_product_id <> '' AND collected_at IS NOT NULL"))


def load_platforms(load: Load, products: DataFrame | None = None) -> None:
    """Seeds first, then platforms only the data knows."""
    seeds = seed_platforms(load.read("dim_platform"))
    start = load.keys.get("dim_platform", 0)
    rank = F.row_number().over(_seed_window())
    load.append("dim_platform", seeds.withColumn("platform_key", rank + start))
    if products is not None:
        found = joins.new_platforms(products, load.read("dim_platform"))
        load.append("dim_platform", load.number("dim_platform", found, ["platform_name"]))


def _seed_window():
    from pyspark.sql import Window

    return Window.orderBy("seed_no")  # the few default rows


def load_dates(load: Load, days: DataFrame) -> None:
    existing = load.read("dim_date")
    style = detect_weekday_style(existing)
    load.append("dim_date", build_dim_date(days, existing, style))
    _gate_zero(joins.missing_dates(days, load.read("dim_date")), "days missing from dim_date")


def _values(df: DataFrame, column: Column) -> list[int]:
    """The months or parts a batch touches: one row for each."""
    with shuffles_freed(df.sparkSession):
        return sorted(r[0] for r in df.select(column.alias("v")).distinct().collect() if r[0] is not None)


def load_new_products(load: Load, rows: DataFrame, at: Column | None = None) -> int:
    """Insert products (dimension columns, optionally ``created_at``) the dimension lacks."""
    new = load.scratch(insert_ignore(load.read("dim_product"), rows, S.PRODUCT_KEY))
    numbered = load.number("dim_product", new, S.PRODUCT_KEY)
    return load.append("dim_product", _stamped(numbered, "created_at", at))


def _stamped(df: DataFrame, column: str, at: Column | None) -> DataFrame:
    at = F.current_timestamp() if at is None else at
    return df.withColumn(column, F.coalesce(F.col(column), at) if column in df.columns else at)


def load_fact_external(
    wh: Warehouse, products: DataFrame, batch: tuple[str, int] | None = None, at: Column | None = None,
    created_at: Callable[[DataFrame], DataFrame] | None = None, policy: str = "insert", dealt: bool = False,
) -> int:
    """Load processed snapshots: dates, platforms, products, then facts.

    The batch is written once in buckets by product; new products, names, the
    pick of one fact per key and the product lookup all work on those buckets
    without shuffling it again. ``dealt`` says that the batch is a table in such buckets; it is then used as it lies.
    ``policy="insert"`` keeps existing facts; ``"upsert"`` overwrites currency,
    price, url and collection time of existing ones. ``created_at`` may add a
    ``created_at`` column to new product rows (for back-filled history).
    Returns the number of new facts. Running a load again adds nothing.
    """
    valid = filter_loadable(products.withColumn("observation_date", F.to_date("observation_date")))
    added: list[int] = []
    with wh.publish(batch) as load:
        if not dealt:
            valid = load.bucketed(valid, BATCH_KEY)
        load_dates(load, valid.select(F.col("observation_date").alias("full_date")))
        load_platforms(load, valid)
        fresh = joins.new_products(valid, load.read("dim_product")).drop("collected_at")
        load_new_products(load, created_at(fresh) if created_at else fresh, at)
        if policy == "upsert":
            refresh_product_names(load, valid, at)
        # Natural and surrogate keys name the same facts, so the pick is made before the lookups, inside the buckets.
        picked = dedupe.dedupe_snapshots(joins.fact_measures(valid, S.SNAPSHOT_KEY))
        resolved = joins.resolve_fact_keys(
            picked, load.read("dim_platform"), load.read("dim_product"), load.read("dim_date")
        )
        # The three lookups run once; the gate and the numbering read their result.
        staged = load.scratch(resolved.drop(*S.SNAPSHOT_KEY))
        _gate_zero(joins.unresolved_facts(staged), "facts without a dimension key")
        months = _values(staged, month_of())
        stored = load.read("fact_external_product", months=months)
        stamped = lambda rows: _stamped(_stamped(rows, "processed_at", at), "loaded_at", at)
        if policy == "upsert":
            changed = ["currency", "price", "product_url", "collected_at", "processed_at"]
            rows = load.numbered_merge("fact_external_product", stored, stamped(staged), S.FACT_KEY, changed)
            load.at_last("fact_external_product", rows, months, added.append, F.col("_is_new"))
        else:
            new = load.number_by_month("fact_external_product", joins.new_facts(staged, stored), S.FACT_KEY, len(months))
            load.at_last("fact_external_product", stamped(new), None, added.append, dealt=True)
    return sum(added)


def refresh_product_names(load: Load, products: DataFrame, at: Column | None = None) -> None:
    """Newest name of every product in the batch; equal times go to the alphabetically last one. Only parts with a changed name are rewritten."""
    newest = F.max_by("product_name", F.struct("collected_at", "product_name")).alias("product_name")
    names = products.groupBy("platform", "external_product_id").agg(newest).withColumnsRenamed(
        {"platform": "source_system", "external_product_id": "source_product_id"})
    stored = load.read("dim_product", [*S.PRODUCT_KEY, "product_name"]).withColumnRenamed("product_name", "_stored")
    changed = load.scratch(stored.join(names, S.PRODUCT_KEY).filter(
        ~F.col("product_name").eqNullSafe(F.col("_stored"))).drop("_stored"))
    touched = _values(changed, part_of(*S.PRODUCT_KEY))
    if touched:
        updated, _ = upsert(load.read("dim_product", months=touched), changed, S.PRODUCT_KEY, ["product_name"], "updated_at", at)
        load.replace("dim_product", updated, touched)


def upsert_fact_external(wh: Warehouse, products: DataFrame, **options) -> int:
    return load_fact_external(wh, products, policy="upsert", **options)


def upsert_dimension(
    load: Load, table: str, source: DataFrame, keys: list[str], set_columns: list[str], stamp: str | None,
    at: Column | None = None,
) -> None:
    """Upsert a dimension. Parts that hold a key of the batch are rewritten, new rows of other parts appended; no other part is read."""
    source = load.scratch(source)
    stored = load.read(table, months=_values(source, part_of(*keys)))
    hits = _values(stored.select(*keys).join(source.select(*keys), keys, "left_semi"), part_of(*keys))
    new = load.scratch(joins.missing_from(source, stored, keys))
    if hits:
        updated, _ = upsert(load.read(table, months=hits), source, keys, set_columns, stamp, at)
        load.replace(table, updated, hits)
    load.append(table, _stamped(load.number(table, new, keys), "created_at", at))


def upsert_dim_product(load: Load, source: DataFrame, at: Column | None = None) -> None:
    """``source``: one row per product with the dimension's natural key and attributes."""
    upsert_dimension(
        load, "dim_product", source, S.PRODUCT_KEY, ["product_name", "category", "brand", "sku"], "updated_at", at
    )


def upsert_dim_customer(load: Load, source: DataFrame, at: Column | None = None) -> None:
    columns = ["customer_code", "gender", "age", "province", "region", "registered_at"]
    upsert_dimension(load, "dim_customer", source, ["source_customer_id"], columns, None, at)


def internal_product_rows(products: DataFrame) -> DataFrame:
    return products.select(
        F.lit(S.INTERNAL_SOURCE).alias("source_system"), F.col("product_id").cast("string").alias("source_product_id"),
        "product_name", "category", "brand", "sku",
    )


def internal_customer_rows(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("customer_id").alias("source_customer_id"), "customer_code", "gender", "age", "province", "region",
        "registered_at",
    )


def upsert_fact_sales(load: Load, orders: DataFrame, order_items: DataFrame, at: Column | None = None) -> int:
    """Sales at item grain, unique per order and product; returns the lines skipped for want of a product."""
    skipped = Observation()
    keyed = joins.keyed_sales_lines(
        orders, order_items, load.read("dim_product"), load.read("dim_customer"), load.read("dim_platform"), skipped)
    # Lines come dealt by order, so the pick needs no shuffle of its own. A product's key stands for its id, and
    # what the table doesn't hold goes no further.
    picked = dedupe.dedupe_sales(keyed.drop("product_id"))
    staged = load.scratch(_stamped(picked, "loaded_at", at).select(*[f.name for f in S.FACT_SALES if f.name != "sales_key"]))
    # A corrected order date moves a sale to another month: the month of each
    # stored sale is kept by a hash of its key, so only the batch's parts are looked up.
    months_of = staged.select(*S.SALES_KEY, month_of().alias("month"))
    touched = _values(staged, part_of(*S.SALES_KEY))
    known = load.read(_MONTHS, months=touched)
    moved = known.join(staged.select(*S.SALES_KEY), S.SALES_KEY, "left_semi")
    with shuffles_freed(load.spark):
        sizes = {r[0]: r[1] for r in staged.groupBy(month_of().alias("v")).count().collect() if r[0] is not None}
    months = sorted({*sizes, *_values(moved, F.col("month"))})
    load.replace(_MONTHS, joins.missing_from(known, staged, S.SALES_KEY).unionByName(months_of), touched)
    stored = load.read("fact_sales", months=months)
    set_columns = [f.name for f in S.FACT_SALES if f.name not in ("sales_key", *S.SALES_KEY)]
    if sizes and "fact_sales" not in load.keys:
        # No sale is stored yet: nothing is updated, and the rows go to their months once, as orders lie.
        new = joins.missing_from(staged, stored, S.SALES_KEY)
        numbered = load.number_in_months("fact_sales", new, S.SALES_KEY, sizes)
        load.at_last("fact_sales", numbered, None, lambda n: None, dealt=True)
    elif months:
        rows = load.numbered_merge("fact_sales", stored, staged, S.SALES_KEY, set_columns)
        load.at_last("fact_sales", rows, months, lambda n: None)
    return skipped.get.get("skipped_lines") or 0


def load_internal(
    wh: Warehouse, products: DataFrame, customers: DataFrame, orders: DataFrame, order_items: DataFrame,
    batch: tuple[str, int] | None = None, at: Column | None = None,
) -> int:
    """Dates, products, customers and sales of the own shop, published together."""
    with wh.publish(batch) as load:
        load_dates(load, joins.distinct_order_dates(orders))
        load_platforms(load)
        upsert_dim_product(load, internal_product_rows(products), at)
        upsert_dim_customer(load, internal_customer_rows(customers), at)
        return upsert_fact_sales(load, orders, order_items, at)


def catalog_dim_rows(catalog: DataFrame) -> DataFrame:
    """Catalog export rows as product dimension rows."""
    valid = filter_catalog_dim(catalog)
    return dedupe.best_title_per_product(valid).select(
        F.lit(S.CATALOG_SOURCE).alias("source_system"), "source_product_id", "product_name",
        C.blank_to_null(F.col("category")).alias("category"), C.blank_to_null(F.col("brand")).alias("brand"),
        F.lit(None).cast("string").alias("sku"),
    )


def load_catalog_dim(wh: Warehouse, catalog: DataFrame, batch: tuple[str, int] | None = None, at: Column | None = None) -> int:
    """Catalog products into the product dimension only; never a price fact."""
    with wh.publish(batch) as load:
        load_platforms(load)
        return load_new_products(load, catalog_dim_rows(catalog), at)
