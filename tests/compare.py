"""Order-insensitive comparison of a Spark result with a SQL result."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if value is None or isinstance(value, (str, bool)):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)) or hasattr(value, "tolist"):
        value = value.tolist() if hasattr(value, "tolist") else value
        return [_plain(v) for v in value] if isinstance(value, (list, tuple)) else _plain(value)
    return value


def canonical(columns: list[str], rows) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_plain(row[i]) for i in order]) for row in rows)


def differences(spark_df, connection, sql: str) -> str:
    """Empty string when the results are equal."""
    found = spark_df.collect()
    cursor = connection.execute(sql)
    names, expected = [d[0] for d in cursor.description], cursor.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    left, right = canonical(spark_df.columns, found), canonical(names, expected)
    if left == right:
        return ""
    only_left, only_right = sorted(set(left) - set(right)), sorted(set(right) - set(left))
    return f"{len(left)} vs {len(right)} rows; spark only {len(only_left)}: {only_left[:2]}; sql only {len(only_right)}: {only_right[:2]}"
