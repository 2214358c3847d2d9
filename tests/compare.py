"""Run a query and its check SQL over the same folder, and compare the rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


KINDS = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean"}


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if type(value).__name__ == "Decimal":
        return round(float(value), 9)
    if isinstance(value, list):
        return tuple(plain(item) for item in value)
    return value


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda place: names[place])
    return Counter(tuple(plain(row[place]) for place in order) for row in rows)


def differences(df, connection, sql: str) -> str | None:
    """None where names, types and rows agree, else what differs."""
    cursor = connection.execute(sql)
    expected_names = [column[0] for column in cursor.description]
    expected_rows = cursor.fetchall()
    expected_kinds = {column[0]: KINDS.get(str(column[1]), str(column[1])) for column in cursor.description}
    if dict(df.dtypes) != expected_kinds:
        return f"columns {dict(df.dtypes)} != {expected_kinds}"
    actual_rows = [tuple(row) for row in df.collect()]
    actual, expected = as_rows(df.columns, actual_rows), as_rows(expected_names, expected_rows)
    if actual == expected:
        return None
    extra, lacking = actual - expected, expected - actual
    return f"{len(actual_rows)} rows, expected {len(expected_rows)}; extra {list(extra)[:3]}; lacking {list(lacking)[:3]}"

