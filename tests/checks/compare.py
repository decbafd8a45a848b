"""Compare a Spark result with DuckDB rows, ignoring order."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duckdb_connection(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return dt.datetime(value.year, value.month, value.day)
    return value


def bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((columns[i], _plain(row[i])) for i in order) for row in rows)


def spark_bag(df) -> Counter:
    return bag(df.columns, [tuple(r) for r in df.collect()])


def duckdb_bag(connection, sql: str) -> tuple[Counter, dict[str, str]]:
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    return bag(names, cursor.fetchall()), kinds
