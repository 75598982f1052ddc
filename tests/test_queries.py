"""Registered queries against their SQL. ``CHECK_ALL=1`` runs every one of them."""

import os

import pytest

import __spark_entry__ as entry_point
from bench import HEADLINE
from check import connect, difference

SF = "/root/testdata/sf0.001"
SQL = entry_point.oracle_sql()
NAMES = sorted(SQL) if os.environ.get("CHECK_ALL") else HEADLINE


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry_point.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = entry_point.queries()[name](spark, SF)
    assert difference(df, df.collect(), con.sql(SQL[name])) is None


def test_entry(spark):
    assert entry_point.entry(spark).count() == 5
