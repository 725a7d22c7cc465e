"""Order-insensitive comparison of a Spark result with DuckDB on the same tables."""

from __future__ import annotations

import datetime as dt
import glob
import os
from collections import Counter

import duckdb

DATA = "/root/testdata/sf0.001"

_KIND = {
    "bigint": "bigint", "int": "int", "integer": "int", "double": "double",
    "string": "text", "varchar": "text", "boolean": "boolean", "date": "date",
    "timestamp_ntz": "timestamp", "timestamp": "timestamp",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value) if isinstance(value, float) else value


def difference(spark_rows, connection, sql: str) -> str | None:
    """None when names, kinds of types and all rows agree."""
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    kinds = {c[0]: _KIND.get(str(c[1]).lower(), str(c[1]).lower()) for c in cursor.description}
    expected = cursor.fetchall()
    if sorted(names) != sorted(spark_rows.columns):
        return f"columns {sorted(spark_rows.columns)} expected {sorted(names)}"
    ours = {n: _KIND.get(t, t) for n, t in spark_rows.dtypes}
    if ours != kinds:
        return f"types {ours} expected {kinds}"
    found = spark_rows.select(*[f"`{n}`" for n in names]).collect()
    left = Counter(tuple(_plain(v) for v in row) for row in found)
    right = Counter(tuple(_plain(v) for v in row) for row in expected)
    if left == right:
        return None
    only = list((left - right).items())[:3], list((right - left).items())[:3]
    return f"{len(found)} rows, expected {len(expected)}; only here {only[0]}; missing {only[1]}"
