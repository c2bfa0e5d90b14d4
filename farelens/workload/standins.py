"""The supplied test tables seen as fare data.

Every fact is a plain projection of one table: like the real fact it carries its station, line and
type keys itself, so no query pays a join to find them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farelens.functions.dates import date_dimension, observed_days
from farelens.plans.load import convert_against, load_star, write_dimensions
from farelens.plans.measures import ReportModel
from farelens.plans.rollups import read_star
from farelens.schemas import EXTRACT_COLUMNS, Star
from farelens.session import fresh_path, stage
from farelens.sources.extracts import CORRUPT

FARE_DIGITAL = ("A", "N")
EVENT_DIGITAL = ("purchase", "signup")


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once, not by a job per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


#: Rows that one task of a pass over an evenly dealt table reads.
EVEN_ROWS = 250_000
_EVEN: dict[tuple[str, str, str], DataFrame] = {}


def even_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A test table for jobs that pass over it many times, dealt evenly over files by ranges of ``key``.

    A file may be one row group, however many rows it has, and only one task can read that. Larger tables are
    therefore copied to the shared folder once per application; the projections and the jobs stay where they were.
    """
    held = (spark.sparkContext.applicationId, sf_dir, name)
    if held not in _EVEN:
        rows = table(spark, sf_dir, name)
        files = -(-rows.count() // EVEN_ROWS)  # counted from file footers
        _EVEN[held] = stage(rows.repartitionByRange(files, key), f"even-{name}") if files > 1 else rows
    return _EVEN[held]


def price_as_fare(price: str) -> Column:
    """A two-digit price held as a double, as decimal(10,2).

    Through whole cents, which is exact here and several times cheaper than the cast that goes
    through the double's text.
    """
    cents = F.floor(F.col(price) * 100 + 0.5).cast("decimal(12,0)")
    return (cents * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(10,2)")


def fare_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem``: suppliers are stations, regions are lines; the first line holds 3/7 of the rows."""
    return table(spark, sf_dir, "lineitem").select(
        F.expr("cast(l_shipdate AS date)").alias("txn_date"),
        F.expr("cast(l_suppkey AS int)").alias("origin_station_id"),
        F.expr("CASE WHEN l_quantity >= 3 THEN cast(l_partkey DIV 20 AS int) END").alias("dest_station_id"),
        F.expr("cast(greatest(l_linenumber - 3, 0) AS smallint)").alias("line_id"),
        F.expr("cast(ascii(l_returnflag) AS smallint)").alias("passenger_type_id"),
        F.col("l_returnflag").alias("ticket_type"),
        F.col("l_linestatus").alias("txn_type"),
        F.expr(
            "CASE WHEN l_discount >= 0.05D THEN 'Adult' WHEN l_discount >= 0.02D THEN 'Student' ELSE 'Senior' END"
        ).alias("fare_type"),
        price_as_fare("l_extendedprice").alias("fare_amount"),
    )


def fare_stations(spark: SparkSession, sf_dir: str, label: str = "s_name") -> DataFrame:
    """Suppliers; their line is the region of their nation. ``n_name`` gives stations that share names."""
    suppliers = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation")
    return suppliers.join(nations, suppliers["s_nationkey"] == nations["n_nationkey"], "left").select(
        F.col("s_suppkey").cast("int").alias("station_id"),
        F.col(label).alias("station_name"),
        F.col("n_regionkey").cast("smallint").alias("line_id"),
        F.lit(False).alias("is_interchange"),
    )


def fare_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("smallint").alias("line_id"),
        F.col("r_name").alias("line_name"),
        F.substring("r_name", 1, 2).alias("line_colour_cc"),
        F.lit(True).alias("is_active"),
    )


def fare_star(spark: SparkSession, sf_dir: str, station_label: str = "s_name") -> Star:
    fact = fare_fact(spark, sf_dir)
    types = fact.groupBy("passenger_type_id").agg(F.min("ticket_type").alias("passenger_type"))
    return Star(
        fact=fact,
        lines=fare_lines(spark, sf_dir),
        stations=fare_stations(spark, sf_dir, station_label),
        passenger_types=types.withColumn("is_digital", F.col("passenger_type").isin(*FARE_DIGITAL)),
    )


def fare_model(spark: SparkSession, sf_dir: str) -> ReportModel:
    star = fare_star(spark, sf_dir)
    return ReportModel(star.fact, star.stations, star.lines, fare_calendar(spark, sf_dir))


_CALENDARS: dict[tuple[str, str], DataFrame] = {}


def fare_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of the fare fact, written once per application like any other dimension."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CALENDARS:
        _CALENDARS[key] = stage(observed_days(fare_fact(spark, sf_dir), "txn_date"), "dim_date")
    return _CALENDARS[key]


def event_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events``: users are stations; some stations appear on two lines."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("transaction_id"),
        F.col("ts").alias("txn_timestamp"),
        F.expr("cast(ts AS date)").alias("txn_date"),
        F.expr("cast(user_id AS int)").alias("origin_station_id"),
        F.expr("CASE WHEN event_id % 5 != 0 THEN cast((user_id * 7) % 150 AS int) END").alias("dest_station_id"),
        F.expr("cast((user_id + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END) % 6 AS smallint)").alias("line_id"),
        F.expr("cast(length(event_type) * 128 + ascii(event_type) AS smallint)").alias("passenger_type_id"),
        F.col("event_type").alias("passenger_type"),
        F.expr("CASE WHEN event_id % 2 = 0 THEN 'Entry' ELSE 'Exit' END").alias("txn_type"),
        F.expr("concat('Fare ', event_id % 4)").alias("fare_type"),
        price_as_fare("value").alias("fare_amount"),
        F.expr("concat('TX-', event_id)").alias("txn_detail"),
    )


def event_star(spark: SparkSession, sf_dir: str, staged: bool = False) -> Star:
    """``staged`` writes the dimensions first, for plans that look up every single fact row."""
    fact = event_fact(spark, sf_dir)
    keep = stage if staged else lambda df, name: df
    lines = fact.select("line_id").distinct()
    stations = fact.groupBy("origin_station_id").agg(F.min("line_id").alias("line_id"))
    types = fact.groupBy("passenger_type_id").agg(F.min("passenger_type").alias("passenger_type"))
    lines = lines.select(
        "line_id",
        F.concat(F.lit("Line "), F.col("line_id").cast("string")).alias("line_name"),
        F.concat(F.lit("C"), F.col("line_id").cast("string")).alias("line_colour_cc"),
        F.lit(True).alias("is_active"),
    )
    stations = stations.select(
        F.col("origin_station_id").alias("station_id"),
        F.concat(F.lit("Station "), F.col("origin_station_id").cast("string")).alias("station_name"),
        "line_id",
        F.lit(False).alias("is_interchange"),
    )
    types = types.withColumn("is_digital", F.col("passenger_type").isin(*EVENT_DIGITAL))
    return Star(
        fact=fact,
        lines=keep(lines, "dim_line"),
        stations=keep(stations, "dim_station"),
        passenger_types=keep(types, "dim_passenger_type"),
        dates=date_dimension(observed_days(fact, "txn_date")),
    )


def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw text with faults on fixed ids, listed in FIXTURES.md."""
    line = "(user_id + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END) % 6"
    columns = {
        "trx_id": "event_id",
        "Sta": "CASE WHEN event_id % 79 = 0 THEN concat('X', user_id) ELSE cast(user_id AS string) END",
        "Dest": (
            "CASE WHEN event_id % 107 = 0 THEN 'ABC' WHEN event_id % 109 = 0 THEN '99999999' "
            "WHEN event_id % 5 = 0 THEN '' ELSE cast((user_id * 7) % 150 AS string) END"
        ),
        "Line": f"concat('Line ', {line})",
        "LineCC": f"concat(CASE WHEN event_id % 211 = 0 THEN 'A' ELSE 'C' END, {line})",
        "PrType": "CASE WHEN event_id % 101 != 0 THEN event_type END",
        "TxT": "CASE WHEN event_id % 2 = 0 THEN 'Entry' ELSE 'Exit' END",
        "FarT": "concat('Fare ', event_id % 4)",
        "Value": (
            "CASE WHEN event_id % 97 = 0 THEN 'N/A' WHEN event_id % 89 = 0 THEN '-5.00' "
            "WHEN event_id % 83 = 0 THEN '' WHEN event_id % 113 = 0 THEN '123456789.00' "
            "ELSE cast(cast(value AS decimal(10,2)) AS string) END"
        ),
        "TrxDetail": "concat('TX-', event_id)",
        "InsertionDateTime": (
            "CASE WHEN event_id % 103 = 0 THEN 'not-a-time' ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END"
        ),
    }
    events = even_table(spark, sf_dir, "events", "event_id")
    return events.select(*[F.expr(text).alias(name) for name, text in columns.items()])


def raw_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows in the 13-column layout of an extract file."""
    raw = raw_landing(spark, sf_dir)
    named = raw.withColumns(
        {
            "transaction_id": F.col("trx_id").cast("string"),
            "station_name": F.concat(F.lit("Station "), "Sta"),
            "dest_station_name": F.when(F.col("Dest") != "", F.concat(F.lit("Station "), "Dest")),
        }
    )
    return named.select(*EXTRACT_COLUMNS)


def faulty_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows with malformed lines and ids that are no numbers as well."""
    return raw_landing(spark, sf_dir).withColumns(
        {
            CORRUPT: F.expr("CASE WHEN trx_id % 131 = 0 THEN concat(trx_id, ',too,few') END"),
            "trx_id": F.expr("CASE WHEN trx_id % 127 != 0 THEN trx_id END"),
        }
    )


def repeated_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows with ids that repeat: equal records, records of another time and fare, and one id on many rows."""
    raw = raw_landing(spark, sf_dir).withColumn("trx_id", F.expr("CASE WHEN trx_id % 50 = 1 THEN 1 ELSE trx_id END"))
    later = {"Value": F.lit("1.00"), "InsertionDateTime": F.lit("2024-03-01 00:00:00")}
    return raw.unionByName(raw.where("trx_id % 10 = 3")).unionByName(raw.where("trx_id % 7 = 2").withColumns(later))


def two_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows, a third of them a month later; days that month lacks are bad times."""
    moved = F.expr("CASE WHEN trx_id % 3 = 1 THEN replace(InsertionDateTime, '2024-01-', '2024-02-') ELSE InsertionDateTime END")
    return raw_landing(spark, sf_dir).withColumn("InsertionDateTime", moved)


_MAINTAINED: dict[tuple[str, str], str] = {}


def maintained_star(spark: SparkSession, sf_dir: str) -> Star:
    """A star after a first load, a load that repeats its rows and adds the rest, and one that replaces a month.

    Loaded once per application, like any stored table.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _MAINTAINED:
        return read_star(spark, _MAINTAINED[key])
    folder = fresh_path(spark, "maintained")
    rows = two_months(spark, sf_dir)
    load_star(rows.where("InsertionDateTime < '2024-01-16' OR InsertionDateTime LIKE '2024-02-1%'"), folder, EVENT_DIGITAL)
    load_star(rows, folder, EVENT_DIGITAL)
    again = rows.where("InsertionDateTime LIKE '2024-02-%'").withColumn("Value", F.lit("2.00"))
    star = load_star(again, folder, EVENT_DIGITAL, replace_months=True)
    _MAINTAINED[key] = folder
    return star


def faulty_star(spark: SparkSession, sf_dir: str) -> Star:
    """``events`` with a fault against every integrity rule."""
    star = event_star(spark, sf_dir, staged=True)
    moved = {
        "transaction_id": "CASE WHEN i % 97 = 0 THEN NULL WHEN i % 101 = 1 THEN i - 1 ELSE i END",
        "txn_timestamp": "CASE WHEN i % 41 != 0 THEN txn_timestamp END",
        "txn_date": "CASE WHEN i % 43 = 0 THEN NULL WHEN i % 47 = 0 THEN date_add(txn_date, 1000) ELSE txn_date END",
        "origin_station_id": "CASE WHEN i % 53 = 0 THEN NULL WHEN i % 59 = 0 THEN 9999999 ELSE origin_station_id END",
        "dest_station_id": "CASE WHEN i % 89 = 0 THEN 9999999 ELSE dest_station_id END",
        "line_id": "cast(CASE WHEN i % 61 = 0 THEN NULL WHEN i % 67 = 0 THEN 99 ELSE line_id END AS smallint)",
        "passenger_type_id": "cast(CASE WHEN i % 71 = 0 THEN NULL WHEN i % 73 = 0 THEN 99 ELSE passenger_type_id END AS smallint)",
        "fare_amount": "CASE WHEN i % 79 = 0 THEN NULL WHEN i % 83 = 0 THEN -1 * fare_amount ELSE fare_amount END",
    }
    fact = star.fact.withColumn("i", F.col("transaction_id"))
    doubled = {
        "lines": star.lines.where("line_id = 0").withColumn("line_id", F.lit(50).cast("smallint")),
        "stations": star.stations.where("station_id IN (1, 2)"),
        "passenger_types": star.passenger_types.where("passenger_type = 'purchase'").withColumn(
            "passenger_type_id", F.lit(51).cast("smallint")
        ),
    }
    return Star(
        fact=fact.withColumns({name: F.expr(text) for name, text in moved.items()}).drop("i"),
        dates=stage(star.dates, "dim_date"),
        **{name: getattr(star, name).unionByName(more) for name, more in doubled.items()},
    )


def converted(spark: SparkSession, sf_dir: str, faulty: bool = False) -> DataFrame:
    """The raw rows through the load, against dimensions written first."""
    raw = faulty_landing(spark, sf_dir) if faulty else raw_landing(spark, sf_dir)
    folder = fresh_path(spark, "dimensions")
    write_dimensions(raw, folder, EVENT_DIGITAL)
    return convert_against(raw, folder)
