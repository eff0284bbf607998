"""Runs queries next to their SQL on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _comparable(value):
    if isinstance(value, float):
        return ("float", math.copysign(0, 1) if value == 0 else value)
    return (type(value).__name__, value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_comparable(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(df):
    return rows_of(df.columns, df.collect())


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    return rows_of([column[0] for column in cursor.description], cursor.fetchall())
