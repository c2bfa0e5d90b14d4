"""Serving views and analysis results over the star schema.

Shape of every plan: aggregate the fact on its own keys (partial aggregation makes hot keys
harmless), then look up labels, then window over the few rows that are left. Where a load has stored sums
on keys that serve, they are added up and the fact isn't read at all.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelens.functions.dates import calendar_attributes
from farelens.functions.numeric import TOTAL, as_decimal, fare_total, mean, percent
from farelens.operators.lookups import label
from farelens.operators.ranking import count_positions
from farelens.operators.trends import change_percent, count_share, share_of_total, trailing_row_mean
from farelens.plans.rollups import estimated_stations, source, totals
from farelens.schemas import Star
from farelens.sources import tables

TARGET_DAILY_REVENUE = 60_000_000  # fixed value: the default benchmark


def headline_kpis(star: Star, approximate: bool = False) -> DataFrame:
    """One row: volume, revenue, average ticket, stations and period.

    ``approximate`` estimates the stations (standard error 1.6 %) from mergeable sketches, which a load keeps
    per day and line; exact is the default.
    """
    rows = source(star, ["txn_date"] if approximate else ["txn_date", "origin_station_id"])
    if "rows" in rows.columns:
        count, paid, revenue = F.sum("rows"), F.sum("paid"), F.sum("revenue").cast(TOTAL)
    else:
        count, paid, revenue = F.count("*"), F.count("fare_amount"), fare_total()
    return rows.agg(
        F.coalesce(count, F.lit(0)).alias("total_transactions"),
        revenue.alias("total_revenue"),
        mean(revenue, paid, 2).alias("avg_ticket_value"),
        (estimated_stations(rows) if approximate else F.count_distinct("origin_station_id")).alias("stations_covered"),
        F.min("txn_date").alias("period_start"),
        F.max("txn_date").alias("period_end"),
    )


def stations_covered(
    star: Star, by: Sequence[str] = (), first: str | None = None, last: str | None = None, approximate: bool = False
) -> DataFrame:
    """Distinct origin stations per ``by`` (of line_id and txn_date) over the days from ``first`` to ``last``.

    Exact by default; ``approximate`` merges the sketches of the days and lines, whatever the selection.
    """
    keys = [*by, "txn_date"] if approximate else [*by, "txn_date", "origin_station_id"]
    rows = source(star, keys)
    if first is not None or last is not None:
        rows = rows.where(tables.days(rows, first or "0001-01-01", last or "9999-12-31"))
    counted = estimated_stations(rows) if approximate else F.count_distinct("origin_station_id")
    return rows.groupBy(*by).agg(counted.alias("stations_covered"))


def daily_totals(star: Star) -> DataFrame:
    return totals(star, "txn_date")


def daily_revenue_rolling(star: Star, rows: int = 30) -> DataFrame:
    """Daily revenue against its trailing row average; the comparison is strict and unrounded."""
    trend = trailing_row_mean("daily_revenue", "txn_date", rows)
    daily = daily_totals(star).select("txn_date", F.col("revenue").alias("daily_revenue"))
    return (
        daily.withColumn("revenue_30d_rolling_avg", trend)
        .withColumn(
            "trend_flag",
            F.when(F.col("daily_revenue") > F.col("revenue_30d_rolling_avg"), "above_trend").otherwise("below_trend"),
        )
        .orderBy("txn_date")
    )


def daily_revenue_trend(star: Star) -> DataFrame:
    """Daily revenue, footfall, average ticket, trailing average and change on the day before."""
    daily = daily_totals(star).select(
        "txn_date",
        F.col("revenue").alias("daily_revenue"),
        F.col("footfall").alias("daily_footfall"),
        mean(F.col("revenue"), F.col("footfall"), 2).alias("avg_ticket_value"),
    )
    return daily.withColumns(
        {
            "revenue_30d_rolling_avg": F.round(trailing_row_mean("daily_revenue", "txn_date"), 2),
            "revenue_dod_pct_change": change_percent("daily_revenue", "txn_date"),
        }
    )


def line_totals(star: Star) -> DataFrame:
    return label(totals(star, "line_id"), star.lines, "line_id", "line_id", line_name="line_name").drop("line_id")


def line_contribution(star: Star) -> DataFrame:
    """Share of network revenue and revenue rank of each line."""
    return (
        line_totals(star)
        .withColumns(
            {
                "revenue_share_pct": share_of_total(F.col("revenue")),
                "revenue_rank": F.rank().over(Window.orderBy(F.col("revenue").desc())),
            }
        )
        .orderBy(F.col("revenue").desc(), "line_name")
    )


def line_revenue_share(star: Star) -> DataFrame:
    return (
        line_totals(star)
        .select(
            "line_name",
            F.col("revenue").alias("total_revenue"),
            F.col("footfall").alias("total_footfall"),
            share_of_total(F.col("revenue")).alias("revenue_share_pct"),
        )
        .orderBy(F.col("total_revenue").desc(), "line_name")
    )


def passenger_mix_by_line(star: Star) -> DataFrame:
    """Passenger types within each line, in percent of the line's transactions."""
    counts = totals(star, "line_id", "passenger_type_id").withColumnRenamed("footfall", "txn_count")
    named = label(counts, star.lines, "line_id", "line_id", line_name="line_name")
    named = label(
        named, star.passenger_types, "passenger_type_id", "passenger_type_id", passenger_type="passenger_type"
    )
    return named.select(
        "line_name",
        "passenger_type",
        "txn_count",
        count_share("txn_count", "line_name").alias("pct_within_line"),
    ).orderBy("line_name", F.col("txn_count").desc(), "passenger_type")


def passenger_mix_network(star: Star) -> DataFrame:
    counts = totals(star, "passenger_type_id").withColumnRenamed("footfall", "txn_count")
    named = label(
        counts, star.passenger_types, "passenger_type_id", "passenger_type_id", passenger_type="passenger_type"
    )
    return named.select("passenger_type", "txn_count", count_share("txn_count").alias("pct_of_network"))


def pair_totals(star: Star, *more_keys: str) -> DataFrame:
    """Totals per pair of origin and destination *names*; stations that share a name merge."""
    by_id = totals(star, "origin_station_id", "dest_station_id", *more_keys).where(F.col("dest_station_id").isNotNull())
    named = label(by_id, star.stations, "origin_station_id", "station_id", origin_station="station_name")
    named = label(named, star.stations, "dest_station_id", "station_id", destination_station="station_name")
    return named.groupBy("origin_station", "destination_station", *more_keys).agg(
        F.sum("footfall").alias("journeys"), F.sum("revenue").alias("revenue")
    )


def od_matrix(star: Star, min_journeys: int = 100, top: int = 500) -> DataFrame:
    """Busy origin-destination pairs per line, the ``top`` by revenue; ties broken by name."""
    pairs = pair_totals(star, "line_id").where(F.col("journeys") > min_journeys)
    named = label(pairs, star.lines, "line_id", "line_id", line_name="line_name")
    return (
        named.select(
            "origin_station",
            "destination_station",
            "line_name",
            "journeys",
            "revenue",
            mean(F.col("revenue"), F.col("journeys"), 2).alias("avg_fare"),
        )
        .orderBy(F.col("revenue").desc(), "origin_station", "destination_station", "line_name")
        .limit(top)
    )


def station_totals(star: Star) -> DataFrame:
    """Totals per origin station and the line on the fact; a station can show under several lines."""
    by_id = totals(star, "origin_station_id", "line_id")
    named = label(
        by_id, star.stations, "origin_station_id", "station_id", station_id="station_id", station_name="station_name"
    )
    named = label(named, star.lines, "line_id", "line_id", line_name="line_name")
    return named.select("station_id", "station_name", "line_name", "footfall", "revenue")


def station_performance(star: Star) -> DataFrame:
    return station_totals(star).withColumn("avg_ticket_value", mean(F.col("revenue"), F.col("footfall"), 2))


def station_ranking(star: Star) -> DataFrame:
    """Busiest and quietest position of every station row, and its share of network revenue."""
    placed = count_positions(station_totals(star), "footfall", "revenue", "station_id", "line_name")
    return placed.select(
        "station_id",
        "station_name",
        "line_name",
        "footfall",
        "revenue",
        F.col("from_largest").alias("busiest_rank"),
        F.col("from_smallest").alias("quietest_rank"),
        percent(F.col("revenue"), F.col("grand_total"), 3).alias("network_revenue_pct"),
    ).orderBy(F.col("revenue").desc(), "station_id", "line_name")


def station_extremes(star: Star) -> DataFrame:
    """The busiest and the quietest station row: positions one from either end."""
    columns = ["station_id", "station_name", "line_name", "footfall", "revenue"]
    row = F.struct(*columns)
    both = station_totals(star).agg(
        F.min_by(row, F.struct(-F.col("footfall"), "station_id", "line_name")).alias("busiest"),
        F.min_by(row, F.struct("footfall", "station_id", "line_name")).alias("quietest"),
    )
    named = [F.struct(F.lit(name).alias("extreme"), F.col(name).alias("row")) for name in ("busiest", "quietest")]
    found = both.select(F.explode(F.array(*named)).alias("e")).where("e.row IS NOT NULL")
    return found.select("e.extreme", *[F.col(f"e.row.{name}").alias(name) for name in columns])


def daily_vs_target(star: Star, target: int = TARGET_DAILY_REVENUE) -> DataFrame:
    """Average daily revenue against a target, and the days that reached it."""
    daily = daily_totals(star).select(F.col("revenue").alias("daily_revenue"))
    goal = F.lit(target).cast("decimal(20,2)")
    expected = goal * as_decimal(F.col("days_measured"))
    overall = daily.agg(
        F.sum("daily_revenue").alias("total"),
        F.count("*").alias("days_measured"),
        F.count_if(F.col("daily_revenue") >= goal).alias("days_at_or_above_target"),
    )
    return overall.select(
        mean(F.col("total"), F.col("days_measured"), 2).alias("actual_daily_avg"),
        F.lit(target).cast("bigint").alias("target_daily_avg"),
        percent(F.col("total") - expected, expected).alias("variance_pct"),
        "days_at_or_above_target",
        "days_measured",
    )


def hourly_profile(star: Star) -> DataFrame:
    """Footfall and revenue by hour of day; hours without rows are absent."""
    hours = star.fact.groupBy(F.hour("txn_timestamp").alias("hour_of_day")).agg(
        F.count("*").alias("footfall"), fare_total().alias("revenue")
    )
    return hours.withColumn("pct_of_daily_footfall", count_share("footfall")).orderBy("hour_of_day")


def revenue_by(star: Star, column: str) -> DataFrame:
    """Totals by a text column of the fact, such as transaction or fare type."""
    return totals(star, column)


def revenue_by_month(star: Star) -> DataFrame:
    """Totals per calendar month name, in month order rather than alphabetically."""
    parts = calendar_attributes(F.col("txn_date"))
    return (
        daily_totals(star)
        .groupBy(parts["month_no"].alias("month_no"), parts["month_name"].alias("month_name"))
        .agg(F.sum("footfall").alias("footfall"), F.sum("revenue").alias("revenue"))
        .orderBy("month_no")
    )


def revenue_date_rollup(star: Star) -> DataFrame:
    """Year, quarter, month, day and grand totals; ``depth`` 0 is the grand total, 4 a single day."""
    parts = calendar_attributes(F.col("txn_date"))
    daily = daily_totals(star).select(
        *[parts[name].alias(name) for name in ("year", "quarter", "month_no")], "txn_date", "footfall", "revenue"
    )
    levels = ["year", "quarter", "month_no", "txn_date"]
    depth = sum((1 - F.grouping(name).cast("int") for name in levels), F.lit(0))
    return daily.rollup(*levels).agg(
        depth.alias("depth"), F.sum("footfall").alias("footfall"), F.sum("revenue").alias("revenue")
    )


def flat_extract(star: Star) -> DataFrame:
    """Fact rows with both station names and the line, in the extract's column layout."""
    named = label(star.fact, star.stations, "origin_station_id", "station_id", "left", station_name="station_name")
    named = label(
        named,
        star.stations,
        "dest_station_id",
        "station_id",
        "left",
        row_id="transaction_id",
        dest_station_name="station_name",
    )
    named = label(
        named, star.lines, "line_id", "line_id", "left", Line="line_name", LineCC="line_colour_cc"
    )
    named = label(
        named, star.passenger_types, "passenger_type_id", "passenger_type_id", "left", PrType="passenger_type"
    )
    return named.select(
        "transaction_id",
        F.col("origin_station_id").alias("Sta"),
        "station_name",
        F.col("dest_station_id").alias("Dest"),
        "dest_station_name",
        "Line",
        "LineCC",
        "PrType",
        F.col("txn_type").alias("TxT"),
        F.col("fare_type").alias("FarT"),
        F.col("fare_amount").alias("Value"),
        F.col("txn_detail").alias("TrxDetail"),
        F.col("txn_timestamp").alias("InsertionDateTime"),
    )


# Names of the serving views.
SERVING_VIEWS: dict[str, Callable[[Star], DataFrame]] = {
    "vw_daily_revenue_trend": daily_revenue_trend,
    "vw_line_revenue_share": line_revenue_share,
    "vw_station_performance": station_performance,
}


def register_views(star: Star) -> None:
    """Name the serving views, so SQL can read them. A stored star answers each read from its loads' sums."""
    for name, build in SERVING_VIEWS.items():
        build(star).createOrReplaceTempView(name)
