"""Every query with SQL against DuckDB on the smallest tables; the others must run."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from catalogue.fixtures import TABLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the test tables")


def cell(value):
    if value is None:
        return ""
    return repr(round(float(value), 8) + 0.0) if isinstance(value, (int, float)) or hasattr(value, "as_tuple") else str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    found = duck.execute(entry.oracle_sql()[name])
    assert normal(df.columns, [tuple(row) for row in df.collect()]) == normal([c[0] for c in found.description], found.fetchall())


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() == 22
