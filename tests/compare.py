"""Compare a Spark result with an oracle result, ignoring row and column order."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = ("lineitem", "orders")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return repr(value)


def _bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list]:
    """Row count and a few differing rows (empty if both sides agree)."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns), (sorted(names), sorted(df.columns))
    expected = _bag(names, result.fetchall())
    actual = _bag(df.columns, df.collect())
    diff = list(((actual - expected) + (expected - actual)).items())
    return sum(actual.values()), diff[:6]
