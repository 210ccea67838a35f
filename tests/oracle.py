"""Compares a registered query with its SQL on the same tables."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{root}/{table}.parquet')")
    return connection


def _exact(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value.hex()
    return value


def _rows(names: list[str], rows: list) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_exact(row[i]) for i in order) for row in rows)


def differences(spark_frame, connection, sql: str) -> list[str]:
    found = connection.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(spark_frame.columns):
        return [f"columns {sorted(names)} and {sorted(spark_frame.columns)}"]
    right = _rows(names, found.fetchall())
    left = _rows(spark_frame.columns, [tuple(r) for r in spark_frame.collect()])
    return [f"spark only: {r}" for r in list((left - right).elements())[:3]] + [
        f"sql only: {r}" for r in list((right - left).elements())[:3]
    ]
