"""Rankings that never sort a whole table in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelens.session import stage


def top_with_ties(df: DataFrame, value: str, n: int) -> DataFrame:
    """Rows whose ``rank`` by descending ``value`` is at most ``n``, ties kept.

    The n-th largest value comes from a top-k (each task keeps n rows) and serves as a threshold.
    """
    cut = df.select(value).orderBy(F.col(value).desc()).limit(n).agg(F.min(value)).scalar()
    return df.where(F.col(value) >= cut)


def count_positions(df: DataFrame, count: str, total: str, id_column: str, tie_column: str) -> DataFrame:
    """Positions from the largest and from the smallest ``count``, and the grand total of ``total``.

    Ties are ordered by ``id_column`` and ``tie_column`` in both directions. A position is the sum of
    three parts: rows with another count, rows with the same count in earlier id blocks, and the
    place inside the block. Counts that add up to N rows take at most sqrt(2N) distinct values, an
    integer id has at most 65536 blocks, and a block holds 65536 ids, so no window sees more.
    The rows are read three times, so they are staged once instead of scanning the fact again.
    Adds ``from_largest``, ``from_smallest`` and ``grand_total``.
    """
    block = F.shiftright(id_column, 16)
    rows = stage(df, "ranked-rows").withColumn("__block", block)
    blocks = rows.groupBy(count, "__block").agg(F.count("*").alias("__n"), F.sum(total).alias("__sum"))

    in_count = Window.partitionBy(count).orderBy("__block")
    block_start = F.coalesce(F.sum("__n").over(in_count.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    counts = blocks.groupBy(count).agg(F.sum("__n").alias("__n"), F.sum("__sum").alias("__sum"))
    ascending = Window.orderBy(F.col(count).asc())
    lower = F.coalesce(F.sum("__n").over(ascending.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    everything = ascending.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = counts.select(
        count,
        lower.alias("__lower"),
        (F.sum("__n").over(everything) - lower - F.col("__n")).alias("__higher"),
        F.sum("__sum").over(everything).alias("grand_total"),
    )
    offsets = blocks.select(count, "__block", block_start.alias("__start")).join(starts, count)
    place = F.row_number().over(Window.partitionBy(count, "__block").orderBy(id_column, tie_column))
    return (
        rows.withColumn("__place", place)
        .join(offsets, [count, "__block"])
        .withColumns(
            {
                "from_largest": F.col("__higher") + F.col("__start") + F.col("__place"),
                "from_smallest": F.col("__lower") + F.col("__start") + F.col("__place"),
            }
        )
        .drop("__block", "__place", "__start", "__lower", "__higher")
    )
