"""Insert-if-absent and surrogate keys for dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def insert_absent(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """``existing`` plus the incoming rows whose key it lacks; conflicts keep the existing row."""
    return existing.unionByName(incoming.join(existing.select(key), key, "left_anti"))


def append_absent(
    existing: DataFrame,
    batch: DataFrame,
    key: str = "transaction_id",
    partition: str | None = None,
    touched: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``batch`` not loaded before, so a replay adds nothing twice.

    Name the ``partition`` column both sides share to read only the partitions the batch touches; where they
    are known beforehand (``touched``, at least those), the batch isn't evaluated to find them.
    """
    if partition is None:
        return batch.join(existing.select(key), key, "left_anti")
    if touched is None:
        touched = batch.select(partition).distinct()
    read = existing.select(partition, key).join(touched, partition, "left_semi")
    return batch.join(read, [partition, key], "left_anti")


def number_rows(df: DataFrame, name: str, order: str, start: int = 0) -> DataFrame:
    """Small-integer surrogate keys in natural-key order, after ``start``.

    For dimensions keyed by a 16-bit number only: the cast fails beyond 32767 rows.
    """
    position = F.row_number().over(Window.orderBy(order)) + F.lit(start)
    return df.withColumn(name, position.cast("smallint"))
