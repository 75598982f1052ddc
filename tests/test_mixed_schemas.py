"""Drops of very many files with a few schemas in conflict."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyshelf.sources import readers

FILES = 1_000


@pytest.fixture(scope="module")
def drops(tmp_path_factory):
    root = tmp_path_factory.mktemp("mixed drops")
    for n in range(FILES):
        price = [pa.array([f"{n}.5"]), pa.array([n + 0.5]), pa.array([n])][n % 3]
        columns = {"product_name": pa.array([f"item {n}"]), "product_url": pa.array([f"https://shop.example/{n}"]), "price": price}
        if n % 3 == 1:
            columns["seller_name"] = pa.array([f"seller {n}"])
        folder = root / f"day {n % 7}"
        folder.mkdir(exist_ok=True)
        pq.write_table(pa.table(columns), folder / f"part {n} 100%.parquet")
    (root / "notes.txt").write_text("no table")
    return str(root)


def test_every_file_is_read_once(spark, drops):
    got = readers.read_heterogeneous_snapshots(spark, drops, "etsy").select("product_name", "price", "seller_name").collect()
    assert sorted((r.product_name, float(r.price), r.seller_name) for r in got) == sorted(
        (f"item {n}", n + (0.0 if n % 3 == 2 else 0.5), f"seller {n}" if n % 3 == 1 else None) for n in range(FILES))


def test_jobs_go_by_schemas_not_files(spark, drops):
    context = spark.sparkContext
    context.setJobGroup("mixed", "schemas of many files")
    try:
        groups = readers._schema_groups(spark, drops)
    finally:
        context._jsc.clearJobGroup()
    assert len(groups) == 3
    assert sum(df.agg(F.count("*")).first()[0] for df in groups) == FILES
    assert len(context.statusTracker().getJobIdsForGroup("mixed")) <= 8


def test_one_schema_keeps_its_own_error(spark, tmp_path):
    (tmp_path / "broken.parquet").write_bytes(b"not a table")
    with pytest.raises(Exception):
        readers.read_heterogeneous_snapshots(spark, str(tmp_path), "etsy")


def test_a_store_pyarrow_cannot_open():
    assert readers._file_schema("viewfs://cluster/drops/a.parquet") is None
