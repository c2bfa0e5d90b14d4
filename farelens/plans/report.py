"""Datasets behind the report's visuals, all under one filter selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.functions.numeric import as_decimal, fare_total
from farelens.operators.lookups import label, same_or_both_blank
from farelens.operators.ranking import top_with_ties
from farelens.operators.trends import share_of_total
from farelens.plans.measures import (
    FACT,
    FIELDS,
    Measure,
    ReportModel,
    Selection,
    evaluate,
    native_keys,
    selected_on_fact,
    selected_sums,
)
from farelens.plans.rollups import add_up, smallest
from farelens.schemas import Rollup, Star
from farelens.session import stage

KPI_MEASURES = ["total_footfall", "total_revenue", "avg_ticket_value", "stations_covered"]

Filters = Mapping[str, Selection] | None


def kpi_cards(model: ReportModel, filters: Filters = None) -> DataFrame:
    return evaluate(model, KPI_MEASURES, filters=filters)


def trend(model: ReportModel, filters: Filters = None) -> DataFrame:
    """Daily revenue and its 30-calendar-day average; dates without sales included."""
    return evaluate(model, ["total_revenue", "revenue_30d_rolling_avg"], ["date"], filters).orderBy("date")


def revenue_by_line(model: ReportModel, filters: Filters = None) -> DataFrame:
    return evaluate(model, ["total_revenue"], ["line_name"], filters).orderBy(
        F.col("total_revenue").desc(), "line_name"
    )


def top_stations(model: ReportModel, n: int = 10, filters: Filters = None) -> DataFrame:
    """Stations whose revenue ranks among the ``n`` largest under the filters; ties kept."""
    stations = evaluate(model, ["total_revenue"], ["station_name"], filters)
    return top_with_ties(stations, "total_revenue", n).orderBy(F.col("total_revenue").desc(), "station_name")


def passenger_mix(model: ReportModel, filters: Filters = None) -> DataFrame:
    """Footfall by line and ticket type, normalised to 100 % per line."""
    rows = evaluate(model, ["total_footfall"], ["line_name", "ticket_type"], filters)
    return rows.withColumn("pct_within_line", share_of_total(as_decimal(F.col("total_footfall")), "line_name"))


def station_flows(star: Star, top: int = 10, both_axes: bool = False) -> DataFrame:
    """Revenue by origin and destination name, destinations limited to the ``top`` by revenue.

    A journey without destination belongs to the blank member, which can rank like any other.
    """
    by_id = star.fact.groupBy("origin_station_id", "dest_station_id").agg(fare_total().alias("revenue"))
    named = label(by_id, star.stations, "origin_station_id", "station_id", "left", origin="station_name")
    named = label(named, star.stations, "dest_station_id", "station_id", "left", destination="station_name")
    return _best_flows(named.groupBy("origin", "destination").agg(F.sum("revenue").alias("revenue")), top, both_axes)


def _best_flows(flows: DataFrame, top: int, both_axes: bool) -> DataFrame:
    result = flows
    for axis in ["destination", "origin"] if both_axes else ["destination"]:
        totals = flows.groupBy(F.col(axis).alias("member")).agg(F.sum("revenue").alias("axis_revenue"))
        best = top_with_ties(totals, "axis_revenue", top)
        result = result.join(best, same_or_both_blank(result[axis], best["member"]), "left_semi")
    return result


def selected_flows(model: ReportModel, filters: Filters = None, top: int = 10, both_axes: bool = False) -> DataFrame:
    """``station_flows`` under a selection, whose station and line are those of the origin."""
    by_id = selected_sums(model, ["origin_station_id", "dest_station_id"], dict(filters or {}))
    named = label(by_id, model.stations, "origin_station_id", "station_id", "left", origin="station_name")
    named = label(named, model.stations, "dest_station_id", "station_id", "left", destination="station_name")
    return _best_flows(named.groupBy("origin", "destination").agg(F.sum("revenue").alias("revenue")), top, both_axes)


def station_flow_totals(star: Star, top: int = 10) -> DataFrame:
    """The flow matrix with its row, column and grand totals; ``level`` 0 marks a plain cell."""
    return (
        station_flows(star, top)
        .cube("origin", "destination")
        .agg(F.grouping_id().cast("int").alias("level"), F.sum("revenue").alias("revenue"))
    )


def flow_matrix_wide(star: Star, destinations: Sequence[str]) -> DataFrame:
    """The matrix with one column per named destination."""
    by_id = star.fact.groupBy("origin_station_id", "dest_station_id").agg(fare_total().alias("revenue"))
    named = label(by_id, star.stations, "origin_station_id", "station_id", origin="station_name")
    named = label(named, star.stations, "dest_station_id", "station_id", destination="station_name")
    return named.groupBy("origin").pivot("destination", list(destinations)).agg(F.sum("revenue"))


def report_model(star: Star) -> ReportModel:
    """The report's view of a stored star, with its stored sums as rollups."""
    types = star.passenger_types.select("passenger_type_id", F.col("passenger_type").alias("ticket_type"))

    def typed(rows: DataFrame) -> DataFrame:
        return rows.join(types, "passenger_type_id", "left")

    stored = tuple(
        Rollup((rollup.keys - {"passenger_type_id"}) | {"ticket_type"}, typed(rollup.table), rollup.row_count)
        if "passenger_type_id" in rollup.keys
        else rollup
        for rollup in star.rollups
    )
    return ReportModel(typed(star.fact), star.stations, star.lines, star.dates.select("date_key"), stored)


def _needs(filters: Filters, days_before: int) -> tuple[list[set[str]], dict]:
    """Keys that the visuals read (those by day and station, and the flows), and the filters that all of them share.

    The trend looks back ``days_before`` days beyond a selected range of dates, so that much of the past stays.
    """
    selected = dict(filters or {})
    shared = {n: s for n, s in selected.items() if FIELDS[n][0] == FACT}
    span = selected.get("date")
    if isinstance(span, tuple):
        shared["date"] = (F.date_sub(F.lit(span[0]).cast("date"), days_before), F.lit(span[1]).cast("date"))
    by_day = set(native_keys(["date", "station_name", "ticket_type", *selected], "origin", whole_dates=True))
    flows = {"origin_station_id", "dest_station_id", *native_keys(list(selected), "origin", whole_dates=True)}
    return [by_day, flows], shared


def shared_sums(model: ReportModel, keys: Sequence[set[str]], filters: Mapping[str, Selection]) -> DataFrame:
    """Sums for several sets of keys from one scan of the fact; ``part`` tells them apart.

    A row goes to every part and is added up there before it moves.
    """
    columns = sorted(set().union(*keys))
    types = {field.name: field.dataType for field in model.fact.schema.fields}
    condition = selected_on_fact(filters, model.fact)
    rows = model.fact if condition is None else model.fact.where(condition)
    parts = [
        F.struct(F.lit(number).alias("part"), *[(F.col(c) if c in own else F.lit(None).cast(types[c])).alias(c) for c in columns])
        for number, own in enumerate(keys)
    ]
    measured = ["rows", "paid", "revenue"] if "rows" in types else ["fare_amount"]
    dealt = rows.select(F.explode(F.array(*parts)).alias("p"), *measured)
    return add_up(dealt.select("p.*", *measured), "part", *columns)


def serve(model: ReportModel, filters: Filters = None, days_before: int = 29) -> ReportModel:
    """The model with rollups that hold all that the visuals read under ``filters``.

    Stored ones serve as they are; otherwise one scan of the fact makes and stages them.
    """
    keys, shared = _needs(filters, days_before)
    if all(smallest(model.rollups, own) for own in keys):
        return model
    staged = stage(shared_sums(model, keys, shared), "report-sums")
    counts = {row["part"]: row["n"] for row in staged.groupBy("part").agg(F.count("*").alias("n")).collect()}  # two rows
    made = tuple(
        Rollup(frozenset(own), staged.where(F.col("part") == number).drop("part"), counts.get(number, 0))
        for number, own in enumerate(keys)
    )
    return replace(model, rollups=made)


def rollup_fact(model: ReportModel, fields: Sequence[str], roles: Sequence[str] = ("origin",)) -> ReportModel:
    """The model over a staged rollup of its fact, just fine enough for ``fields``.

    One heavy scan; every dataset then reads the small table.
    """
    keys = sorted({key for role in roles for key in native_keys(fields, role, whole_dates=True)})
    rollup = model.fact.groupBy(*keys).agg(F.count("*").alias("rows"), fare_total().alias("revenue"))
    return ReportModel(stage(rollup, "report-rollup"), model.stations, model.lines, model.calendar)


def dashboard(model: ReportModel, filters: Filters = None, known: Mapping[str, Measure] | None = None) -> DataFrame:
    """Every dataset under the same selection, in long form: dataset, member, footfall, revenue.

    An empty selection is the cleared dashboard.
    """
    both = ["total_footfall", "total_revenue"]
    grouped = {
        "kpi": None,
        "trend": "date",
        "line": "line_name",
        "station": "station_name",
        "ticket_type": "ticket_type",
    }
    served = rollup_fact(model, [*filter(None, grouped.values()), *(filters or {})])
    parts = []
    for dataset, field in grouped.items():
        rows = evaluate(served, both, [field] if field else [], filters, known)
        member = F.col(field).cast("string") if field else F.lit("all")
        parts.append(rows.select(F.lit(dataset).alias("dataset"), member.alias("member"), *both))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def all_datasets(model: ReportModel, filters: Filters = None, top: int = 10) -> DataFrame:
    """All six visuals under one selection, in long form: dataset, member, second_member, measure, value.

    Each visual has its own measures; an empty selection is the cleared dashboard. The fact is scanned once,
    or not at all where stored sums serve.
    """
    model = serve(model, filters)
    mix = passenger_mix(model, filters)
    flows = selected_flows(model, filters, top).withColumnsRenamed({"origin": "member", "destination": "second_member"})
    blank = F.lit(None).cast("string")
    parts = [
        ("kpi", kpi_cards(model, filters).withColumns({"member": blank, "second_member": blank})),
        ("trend", trend(model, filters).withColumns({"member": F.col("date").cast("string"), "second_member": blank}).drop("date")),
        ("line", revenue_by_line(model, filters).withColumnRenamed("line_name", "member").withColumn("second_member", blank)),
        ("station", top_stations(model, top, filters).withColumnRenamed("station_name", "member").withColumn("second_member", blank)),
        ("mix", mix.withColumnsRenamed({"line_name": "member", "ticket_type": "second_member"})),
        ("matrix", flows),
    ]
    result = None
    for dataset, rows in parts:
        measures = [name for name in rows.columns if name not in ("member", "second_member")]
        values = rows.select("member", "second_member", *[F.col(name).cast("decimal(38,8)").alias(name) for name in measures])
        long = values.unpivot(["member", "second_member"], measures, "measure", "value").where("value IS NOT NULL")
        long = long.select(F.lit(dataset).alias("dataset"), "member", "second_member", "measure", "value")
        result = long if result is None else result.unionByName(long)
    return result
