"""Dimension look-ups.

Facts are aggregated on their keys first and labelled afterwards, so these joins see one row per
key, not one per transaction. No side is hinted: Catalyst broadcasts a dimension whose measured
size allows it and otherwise shuffles both (already small) sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_SPREAD = 1024


def spread_blanks(key: Column, row_id: Column) -> Column:
    """``key`` with blanks replaced by many different negative numbers.

    Rows without a key match nothing but would all hash to one task of a shuffle join.
    """
    return F.coalesce(key, (F.lit(-1) - F.pmod(F.xxhash64(row_id), F.lit(_SPREAD))).cast("int"))


def label(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str,
    how: str = "inner",
    row_id: str | None = None,
    **columns: str,
) -> DataFrame:
    """Join ``dim`` on ``df[key] = dim[dim_key]``; ``columns`` maps new names to ``dim`` columns.

    The same dimension can be joined again under other names, once per role it plays. For a left
    look-up of whole fact rows, ``row_id`` names the column that spreads rows without a key.
    """
    picked = dim.select(
        F.col(dim_key).alias("__dim_key"), *[F.col(source).alias(name) for name, source in columns.items()]
    )
    if row_id is None:
        return df.join(picked, df[key] == picked["__dim_key"], how).drop("__dim_key")
    joined = df.join(picked, spread_blanks(df[key], df[row_id]) == picked["__dim_key"], how).drop("__dim_key")
    return joined.withColumns({name: F.when(F.col(key).isNotNull(), F.col(name)) for name in columns})


def same_or_both_blank(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)
