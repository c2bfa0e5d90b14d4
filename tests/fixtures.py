"""Small hand-written frames."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from farelens.functions.dates import date_dimension, observed_days
from farelens.plans.measures import ReportModel
from farelens.schemas import (
    FACT_SCHEMA,
    LINE_SCHEMA,
    PASSENGER_TYPE_SCHEMA,
    RAW_COLUMNS,
    STATION_SCHEMA,
    Star,
    text_schema,
)
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINES = [(1, "Red", "R", True), (2, "Blue", "B", True)]
STATIONS = [(10, "North", 1, False), (11, "South", 1, False), (12, "East", 2, False), (13, "North", 2, False)]
TYPES = [(1, "NCMC", True), (2, "QR Ticket", True), (3, "Other", False)]


def trip(day, origin, dest, line, ptype, fare, hour=8, number=0):
    day = dt.date.fromisoformat(day)
    return (
        number,
        dt.datetime(day.year, day.month, day.day, hour),
        day,
        origin,
        dest,
        line,
        ptype,
        "Entry",
        "Adult",
        None if fare is None else Decimal(fare),
        None,
    )


def star(spark, trips, lines=LINES, stations=STATIONS, types=TYPES) -> Star:
    rows = [(number, *row[1:]) for number, row in enumerate(trips)]
    fact = spark.createDataFrame(rows, FACT_SCHEMA)
    return Star(
        fact=fact,
        lines=spark.createDataFrame(lines, LINE_SCHEMA),
        stations=spark.createDataFrame(stations, STATION_SCHEMA),
        passenger_types=spark.createDataFrame(types, PASSENGER_TYPE_SCHEMA),
        dates=date_dimension(observed_days(fact, "txn_date")),
    )


def model(spark, trips, **options) -> ReportModel:
    built = star(spark, trips, **options)
    names = built.passenger_types.select("passenger_type_id", F.col("passenger_type").alias("ticket_type"))
    fact = built.fact.join(names, "passenger_type_id", "left")
    return ReportModel(fact, built.stations, built.lines, observed_days(built.fact, "txn_date"))


GOOD = {
    "Sta": "10",
    "Dest": "11",
    "Line": "Red",
    "LineCC": "R",
    "PrType": "NCMC",
    "TxT": "Entry",
    "FarT": "Adult",
    "Value": "12.50",
    "TrxDetail": "x",
    "InsertionDateTime": "2024-05-01 08:30:00",
}


def raw(spark, *changes):
    """Raw rows: a good one with the given changes; ids count from 0."""
    rows = [(number, *[{**GOOD, **change}[name] for name in RAW_COLUMNS]) for number, change in enumerate(changes)]
    schema = T.StructType([T.StructField("trx_id", T.LongType()), *text_schema(RAW_COLUMNS).fields])
    return spark.createDataFrame(rows, schema)


def values(df, *columns):
    """Rows as plain tuples, decimals as floats."""
    picked = df.select(*columns) if columns else df
    return [tuple(float(v) if isinstance(v, Decimal) else v for v in row) for row in picked.collect()]
