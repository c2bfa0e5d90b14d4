"""Windows over one row per day.

They run unpartitioned, which is safe only above the daily aggregate: a date column has a few
thousand distinct values, whatever the number of transactions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelens.functions.numeric import as_decimal, mean, percent


def trailing_row_mean(value: str, day: str, rows: int = 30) -> Column:
    """Mean over the current and the preceding ``rows - 1`` rows (days that have sales)."""
    window = Window.orderBy(day).rowsBetween(-(rows - 1), 0)
    return mean(F.sum(value).over(window), F.count(value).over(window))


def change_percent(value: str, day: str) -> Column:
    """Change against the previous row in percent; blank on the first row and after a zero."""
    previous = F.lag(value).over(Window.orderBy(day))
    return percent(F.col(value) - previous, F.nullif(previous, F.lit(0)))


def share_of_total(value: Column, *partition: str) -> Column:
    """``value`` in percent of its total over ``partition`` (all rows when empty)."""
    return percent(value, F.sum(value).over(Window.partitionBy(*partition)))


def count_share(count: str, *partition: str) -> Column:
    return share_of_total(as_decimal(F.col(count)), *partition)


def trailing_day_totals(
    daily: DataFrame, anchors: DataFrame, keys: list[str], groups: list[str], day: str, value: str, days: int
) -> DataFrame:
    """Sum and day count of ``value`` over the ``days`` calendar days ending at each ``anchor``.

    ``daily`` has at most one row per ``keys`` and day, ``anchors`` one anchor date per combination of
    ``groups``, no date twice. Running totals replace the windows: a window's sum is the total up to its
    anchor less the total before its first day. A day with a value stands for the anchors up to the next such
    day, so each result is made once, however long the window; rows grow with days, not days times ``days``.
    Anchors need no value of their own, and windows without any drop out.
    """
    per_key = Window.partitionBy(*keys).orderBy("__day")
    following = F.lead("__day").over(per_key)
    reach = F.least(F.date_sub(following, 1), F.date_add("__day", days - 1))
    valued = daily.select(*keys, F.col(value).alias("__value"), F.col(day).alias("__day"))
    covered = valued.withColumn("__reach", reach).withColumn(
        "anchor", F.explode(F.sequence("__day", "__reach", F.expr("INTERVAL 1 DAY")))
    )
    results = covered.select(*keys, "anchor").join(anchors.select("anchor"), "anchor", "left_semi")
    # One running total over values and, for each result, a mark at either end of its window. A mark counts
    # the values of its day and before.
    ends = F.explode(
        F.array(
            F.struct(F.col("anchor").alias("day"), F.lit(1).alias("sign")),
            F.struct(F.date_sub("anchor", days).alias("day"), F.lit(-1).alias("sign")),
        )
    )
    marks = results.select(*keys, "anchor", ends.alias("end")).select(
        *keys, F.col("end.day").alias("__day"), F.lit(None).cast(valued.schema["__value"].dataType).alias("__value"), "anchor",
        F.col("end.sign").alias("sign"),
    )
    none = [F.lit(None).cast("date").alias("anchor"), F.lit(0).alias("sign")]
    running = Window.partitionBy(*keys).orderBy("__day", F.abs("sign")).rowsBetween(Window.unboundedPreceding, 0)
    summed = valued.select(*keys, "__day", "__value", *none).unionByName(marks).select(
        *keys, "anchor", "sign", F.sum("__value").over(running).alias("total"), F.count("__value").over(running).alias("days")
    )
    sums = (
        summed.where("sign <> 0")
        .groupBy(*keys, "anchor")
        .agg(F.sum(F.col("sign") * F.col("total")).alias("window_total"), F.sum(F.col("sign") * F.col("days")).alias("window_days"))
    )
    return sums.join(anchors, "anchor").select(*keys, *groups, "window_total", "window_days")
