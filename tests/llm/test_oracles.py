"""Every query of the operators that has SQL, against DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from lift.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the test tables")
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for table in ("embeddings", "pages", "conversations"):
        db.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    want = db.sql(ORACLES[name])
    got = QUERIES[name](spark, FOLDER)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR"}
    assert {f.name: kinds[f.dataType.simpleString()] for f in got.schema} == dict(zip(want.columns, map(str, want.types)))
    columns = sorted(want.columns)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=str) == sorted(want.select(*columns).fetchall(), key=str)
