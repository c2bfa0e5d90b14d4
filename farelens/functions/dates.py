"""Calendar attributes as plain expressions, and date series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar_attributes(day: Column) -> dict[str, Column]:
    """Attributes of a date; ISO week days, Monday = 1."""
    iso_day = F.weekday(day) + 1
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "quarter_label": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "month_no": F.month(day),
        "month_name": F.date_format(day, "MMM"),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": iso_day,
        "day_name": F.date_format(day, "EEE"),
        "is_weekend": iso_day >= 6,
    }


def observed_days(df: DataFrame, first: str, last: str | None = None) -> DataFrame:
    """Every day from the smallest ``first`` to the largest ``last`` date; gap days included."""
    bounds = df.agg(F.min(first).alias("first_day"), F.max(last or first).alias("last_day"))
    return bounds.where(F.col("first_day").isNotNull()).select(
        F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("date_key")
    )


def days_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Every day of a fixed, inclusive range."""
    return spark.range(1).select(
        F.explode(
            F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("INTERVAL 1 DAY"))
        ).alias("date_key")
    )


def date_dimension(days: DataFrame) -> DataFrame:
    """The date table: key and eight attributes."""
    parts = calendar_attributes(F.col("date_key"))
    return days.select(
        "date_key",
        parts["year"].cast("smallint").alias("year"),
        parts["quarter"].cast("smallint").alias("quarter"),
        parts["month_no"].cast("smallint").alias("month"),
        parts["month_name"].alias("month_name"),
        parts["day_of_month"].cast("smallint").alias("day_of_month"),
        parts["day_of_week"].cast("smallint").alias("day_of_week"),
        parts["day_name"].alias("day_name"),
        parts["is_weekend"].alias("is_weekend"),
    )


def report_calendar(days: DataFrame, with_quarter: bool = True) -> DataFrame:
    """The report's calendar table; quarter label and day number are optional."""
    parts = calendar_attributes(F.col("date_key"))
    wanted = ["year"] + (["quarter_label"] if with_quarter else []) + ["month_name", "month_no"]
    wanted += (["day_of_month"] if with_quarter else []) + ["day_name", "is_weekend"]
    return days.withColumns({name: parts[name] for name in wanted})
