"""Declared schemas: raw extract, raw landing table and star tables. Nothing is inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)

# Payload columns of the raw record, in file order.
RAW_COLUMNS = [
    "Sta",
    "Dest",
    "Line",
    "LineCC",
    "PrType",
    "TxT",
    "FarT",
    "Value",
    "TrxDetail",
    "InsertionDateTime",
]

# Header of the flat extract file.
EXTRACT_COLUMNS = [
    "transaction_id",
    "Sta",
    "station_name",
    "Dest",
    "dest_station_name",
    "Line",
    "LineCC",
    "PrType",
    "TxT",
    "FarT",
    "Value",
    "TrxDetail",
    "InsertionDateTime",
]

# Passenger types counted as digital.
DIGITAL_TYPES = ["NCMC", "QR Ticket"]


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


RAW_SCHEMA = T.StructType(
    [T.StructField("trx_id", T.LongType())]
    + [T.StructField(name, T.StringType()) for name in RAW_COLUMNS]
    + [T.StructField("ingested_at", T.TimestampType())]
)

# Column names of the star tables and dimension files below.
LINE_SCHEMA = T.StructType(
    [
        T.StructField("line_id", T.ShortType()),
        T.StructField("line_name", T.StringType()),
        T.StructField("line_colour_cc", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
    ]
)

LINE_FILE_SCHEMA = T.StructType(
    [
        T.StructField("line_id", T.IntegerType()),
        T.StructField("line_name", T.StringType()),
        T.StructField("line_colour_cc", T.StringType()),
        T.StructField("revenue_share_target_pct", T.DoubleType()),
    ]
)

STATION_SCHEMA = T.StructType(
    [
        T.StructField("station_id", T.IntegerType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("line_id", T.ShortType()),
        T.StructField("is_interchange", T.BooleanType()),
    ]
)

STATION_FILE_SCHEMA = T.StructType(
    [
        T.StructField("station_id", T.IntegerType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("line_id", T.IntegerType()),
        T.StructField("line_name", T.StringType()),
        T.StructField("is_interchange", T.BooleanType()),
    ]
)

PASSENGER_TYPE_SCHEMA = T.StructType(
    [
        T.StructField("passenger_type_id", T.ShortType()),
        T.StructField("passenger_type", T.StringType()),
        T.StructField("is_digital", T.BooleanType()),
    ]
)

DATE_SCHEMA = T.StructType(
    [
        T.StructField("date_key", T.DateType()),
        T.StructField("year", T.ShortType()),
        T.StructField("quarter", T.ShortType()),
        T.StructField("month", T.ShortType()),
        T.StructField("month_name", T.StringType()),
        T.StructField("day_of_month", T.ShortType()),
        T.StructField("day_of_week", T.ShortType()),
        T.StructField("day_name", T.StringType()),
        T.StructField("is_weekend", T.BooleanType()),
    ]
)

FACT_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("txn_timestamp", T.TimestampNTZType()),
        T.StructField("txn_date", T.DateType()),
        T.StructField("origin_station_id", T.IntegerType()),
        T.StructField("dest_station_id", T.IntegerType()),
        T.StructField("line_id", T.ShortType()),
        T.StructField("passenger_type_id", T.ShortType()),
        T.StructField("txn_type", T.StringType()),
        T.StructField("fare_type", T.StringType()),
        T.StructField("fare_amount", MONEY),
        T.StructField("txn_detail", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Rollup:
    """An aggregate of the fact: rows, paid and revenue per combination of ``keys``, perhaps in several parts."""

    keys: frozenset[str]
    table: DataFrame
    row_count: int


@dataclass(frozen=True)
class Star:
    """The star schema as DataFrames. Dimension keys are unique; ``rollups`` hold what the fact holds."""

    fact: DataFrame
    lines: DataFrame
    stations: DataFrame
    passenger_types: DataFrame | None = None
    dates: DataFrame | None = None
    rollups: tuple[Rollup, ...] = ()
