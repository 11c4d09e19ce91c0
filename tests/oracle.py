"""Compare a query with its SQL counterpart in DuckDB, value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import os

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as spark_entry


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in sorted(os.listdir(folder)):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{folder}/{name}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark: SparkSession, folder: str, name: str, con=None) -> str | None:
    """None if query and SQL agree exactly, else what differs."""
    con = con or connect(folder)
    df = spark_entry.queries()[name](spark, folder)
    columns, got = _normal(df.columns, df.collect())
    cursor = con.execute(spark_entry.oracle_sql()[name])
    expected_columns, expected = _normal([d[0] for d in cursor.description], cursor.fetchall())
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    wrong = [(g, e) for g, e in zip(got, expected) if g != e]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, columns {columns}: {wrong[:3]}"
    types = [(d[0], str(d[1])) for d in cursor.description]
    drift = [(n, t, df.schema[n].dataType.simpleString()) for n, t in types
             if t in ("HUGEINT",) or t.startswith("DECIMAL")]
    return f"types {drift}" if drift else None
