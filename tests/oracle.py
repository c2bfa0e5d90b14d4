"""Runs a registered query and its SQL on the same tables and compares the results."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{os.path.join(sf_dir, name)}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return str(value)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(frame, connection, sql: str) -> str | None:
    """None when equal, else a short description of the difference."""
    result = connection.execute(sql)
    expected_names = [column[0] for column in result.description]
    expected = result.fetchall()
    actual = [tuple(row) for row in frame.collect()]
    if sorted(frame.columns) != sorted(expected_names):
        return f"columns {sorted(frame.columns)} != {sorted(expected_names)}"
    left, right = _sorted_rows(frame.columns, actual), _sorted_rows(expected_names, expected)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    different = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(different)} rows differ, first {different[0]}" if different else None
