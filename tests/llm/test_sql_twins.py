"""SQL twins over whole tables."""

from __future__ import annotations

import duckdb
import pytest

from orderlens.llm.oracles import ORACLES
from orderlens.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    got = QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(names).collect())) == sorted(cursor.fetchall())
