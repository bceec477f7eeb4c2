"""Compares a Spark result with the rows DuckDB gives for the SQL twin."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _key(row):
    return tuple((value is None, str(value)) for value in row)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(v) for v in row) for row in df.select(*names).collect()), key=_key)


def duck_rows(connection, sql):
    result = connection.execute(sql)
    found = [column[0] for column in result.description]
    order = sorted(range(len(found)), key=lambda i: found[i])
    rows = [tuple(plain(row[i]) for i in order) for row in result.fetchall()]
    return [found[i] for i in order], sorted(rows, key=_key)


def differences(df, connection, sql, limit: int = 3) -> list[str]:
    names, rows = spark_rows(df)
    wanted_names, wanted = duck_rows(connection, sql)
    if names != wanted_names:
        return [f"columns {names} != {wanted_names}"]
    if len(rows) != len(wanted):
        return [f"{len(rows)} rows != {len(wanted)} rows"]
    found = []
    for row, other in zip(rows, wanted):
        same = all(a == b and type(a) is type(b) for a, b in zip(row, other))
        if not same:
            found.append(f"{row} != {other}")
    return found[:limit] + ([f"... {len(found)} rows differ"] if len(found) > limit else [])
