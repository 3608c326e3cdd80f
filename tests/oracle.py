"""Compare registered queries with their SQL, run by DuckDB on the same files."""

from __future__ import annotations

import glob
import math
import os
from datetime import date, datetime

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(file).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{file}')")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


# Spark and DuckDB names of the same types.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
    "double": "DOUBLE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, connection, folder, build, sql) -> str | None:
    """None if both sides agree, else what differs."""
    df = build(spark, folder)
    found = connection.execute(sql)
    names = [d[0] for d in found.description]
    types = {d[0]: str(d[1]) for d in found.description}
    expected = found.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} are not {sorted(names)}"
    for name, kind in df.dtypes:
        if SAME_TYPE[kind] != types[name]:
            return f"{name} is {kind}, expected {types[name]}"
    got = bag(df.collect(), df.columns)
    want = bag(expected, names)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
