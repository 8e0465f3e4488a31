"""Compare a Spark result with a DuckDB result: names, kinds of types, rows, values."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def differences(spark_df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = [dict(zip(names, row)) for row in cursor.fetchall()]
    ours = [row.asDict() for row in spark_df.collect()]
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} against {sorted(names)}"]
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows against {len(theirs)}"]
    left, right = _bag(ours), _bag(theirs)
    extra, lacking = list((left - right).elements()), list((right - left).elements())
    return [f"only Spark: {extra[:3]}", f"only SQL: {lacking[:3]}"] if extra or lacking else []


def _bag(rows: list[dict]) -> Counter:
    return Counter(tuple((k, _plain(r[k])) for k in sorted(r)) for r in rows)


def _plain(value):
    if isinstance(value, Decimal):
        raise TypeError("a decimal is left in a result")
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value
