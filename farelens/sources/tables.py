"""Star tables on disk: write, read back, register by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.schemas import (
    DATE_SCHEMA,
    FACT_SCHEMA,
    LINE_SCHEMA,
    MONEY,
    PASSENGER_TYPE_SCHEMA,
    STATION_SCHEMA,
    Star,
)

MONTH = "txn_month"


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def write_dimension(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_fact(
    df: DataFrame,
    path: str,
    extra_partitions: tuple[str, ...] = (),
    mode: str = "overwrite",
    dynamic: bool = True,
    station_bounds: list[int] | None = None,
    row_group_bytes: int | None = None,
) -> None:
    """Write rows partitioned by month, in date order inside each file.

    The rebalance step gathers a month into few files and lets AQE split a month that is too big
    for one task. With ``overwrite``, only the months present in ``df`` are replaced, and all of the
    path if ``dynamic`` is off.

    ``station_bounds`` orders a month along a curve over origin, destination and day instead, in files cut by
    sampled ranges of that order: row groups then hold few origins and few destinations, and their statistics
    let a filter on either skip most of them. Sampling reads ``df`` twice, so it should be a table.
    """
    partitions = [*extra_partitions, MONTH]
    rows = df.withColumn(MONTH, month_of(F.col("txn_date")))
    if station_bounds is None:
        placed = rows.hint("rebalance", *[F.col(name) for name in partitions]).sortWithinPartitions(*partitions, "txn_date")
    else:
        placed = along_curve(rows, partitions, station_bounds)
    writer = placed.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.partitionBy(*partitions).parquet(path)


CURVE_BITS = 6


def station_bounds(stations: DataFrame) -> list[int]:
    """Station ids that cut the stations in 2^CURVE_BITS about equal steps: at most 63 numbers."""
    steps = 1 << CURVE_BITS
    cuts = F.percentile_approx("station_id", F.array(*[F.lit(i / steps) for i in range(1, steps)]), F.lit(10_000))
    return sorted(set(stations.agg(cuts).first()[0] or []))


def along_curve(rows: DataFrame, partitions: list[str], bounds: list[int]) -> DataFrame:
    """``rows`` in ranges of ``partitions`` and the curve over origin, destination and day, sorted inside each.

    The places are columns while rows move: a sort works out an expression anew at every comparison.
    """
    sides = {"__origin_step": station_step("origin_station_id", bounds), "__dest_step": station_step("dest_station_id", bounds)}
    placed = rows.withColumns(sides).withColumns(
        {"__place": pair_curve(*sides), "__spread": F.xxhash64("transaction_id")}  # the hash splits a hot pair
    )
    order = [*partitions, "__place", "__spread"]
    return placed.drop(*sides).repartitionByRange(*order).sortWithinPartitions(*order).drop("__place", "__spread")


def station_step(station: str, bounds: list[int]) -> Column:
    """How many of ``bounds`` the station reaches, which keeps the stations' order; 0 for a blank one."""
    numbers = F.array(*[F.lit(bound) for bound in bounds]) if bounds else F.array().cast("array<int>")
    return F.coalesce(F.size(F.filter(numbers, lambda bound: bound <= F.col(station))), F.lit(0))


def pair_curve(*sides: str) -> Column:
    """Place of a row on a curve that interleaves the bits of the steps of both ``sides`` and, behind them, the day."""
    day = F.dayofmonth("txn_date") - 1
    bits = []
    for bit in range(CURVE_BITS - 1, -1, -1):
        bits += [F.shiftright(side, bit).bitwiseAND(F.lit(1)) for side in sides]
        if bit < 3:  # the day's three high bits, among the stations' low ones
            bits.append(F.shiftright(day, bit + 2).bitwiseAND(F.lit(1)))
    place = F.lit(0)
    for bit in bits:
        place = place * 2 + bit
    return place


def _with_month(schema: T.StructType, extra: tuple[T.StructField, ...] = ()) -> T.StructType:
    return T.StructType([*schema.fields, *extra, T.StructField(MONTH, T.StringType())])


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_with_month(FACT_SCHEMA)).parquet(path)


LOAD_FIELDS = (
    T.StructField("fare_text", T.StringType()),
    T.StructField("raw_text", T.StringType()),
    T.StructField("reject_reason", T.StringType()),
    T.StructField("load_seq", T.IntegerType()),
    T.StructField("status", T.StringType()),
)
LOADS_SCHEMA = T.StructType(
    [
        T.StructField("load_seq", T.IntegerType()),
        T.StructField("replaced", T.ArrayType(T.StringType())),
        T.StructField("rollup_rows", T.MapType(T.StringType(), T.LongType())),
    ]
)
PARTITIONS = (T.StructField("load_seq", T.IntegerType()), T.StructField(MONTH, T.StringType()))


def load_folder(folder: str, number: int) -> str:
    return f"{folder}/fact/load_seq={number}"


def _exists(spark: SparkSession, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def read_loads(spark: SparkSession, folder: str) -> list:
    """Finished loads in order, one small row each: load_seq, the months it replaced, the rows of its rollups."""
    path = f"{folder}/loads"
    if not _exists(spark, path):
        return []
    return sorted(spark.read.schema(LOADS_SCHEMA).parquet(path).collect(), key=lambda row: row.load_seq)


def commit_load(spark: SparkSession, folder: str, number: int, replaced: list[str], rollup_rows: dict[str, int] | None = None) -> None:
    """Make a written load visible."""
    done = spark.createDataFrame([(number, replaced, rollup_rows)], LOADS_SCHEMA)
    done.coalesce(1).write.mode("append").parquet(f"{folder}/loads")


def months_of_load(spark: SparkSession, path: str) -> list[str]:
    """Months that a load's accepted rows fall in."""
    rows = spark.read.schema(T.StructType([T.StructField("status", T.StringType()), T.StructField(MONTH, T.StringType())]))
    found = rows.parquet(path).where("status = 'accepted'").select(MONTH).distinct().collect()
    return sorted(row[0] for row in found)


def read_loaded(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of finished loads, accepted and rejected, with load_seq, status and month.

    Loads and replaced months are folder conditions, so hidden rows are never read.
    """
    rows = spark.read.schema(_with_month(FACT_SCHEMA, LOAD_FIELDS)).parquet(f"{folder}/fact")
    return rows.where(visible(read_loads(spark, folder), F.col("status") == "accepted"))


def visible(loads: list, hideable: Column | None = None) -> Column:
    """Folder condition: parts of finished loads, without the months that a later load has replaced.

    Only ``hideable`` rows give way to a replacement; all of them by default.
    """
    shown = F.col("load_seq").isin([load.load_seq for load in loads])
    for load in loads:
        if load.replaced:
            # As an array: an equality on the month, wherever it stands, makes Spark leave out dynamic pruning by it.
            months = F.array(*[F.lit(month) for month in load.replaced])
            hidden = (F.col("load_seq") < load.load_seq) & F.array_contains(months, F.col(MONTH))
            hidden = hidden if hideable is None else hideable & hidden
            shown = shown & ~F.coalesce(hidden, F.lit(False))
    return shown


def read_own(spark: SparkSession, folder: str, number: int) -> DataFrame:
    """Accepted rows that one load has written, finished or not."""
    rows = spark.read.schema(_with_month(FACT_SCHEMA, LOAD_FIELDS)).parquet(load_folder(folder, number))
    return rows.where("status = 'accepted'").select(*[field.name for field in FACT_SCHEMA.fields], MONTH)


def days(fact: DataFrame, first, last) -> Column:
    """Inclusive date filter that also names the months, so whole month folders are skipped."""
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    wanted = F.col("txn_date").between(low, high)
    if MONTH in fact.columns:
        wanted = wanted & F.col(MONTH).between(month_of(low), month_of(high))
    return wanted


def read_star(spark: SparkSession, folder: str) -> Star:
    """The star as the last finished load left it."""
    last = f"{folder}/dimensions/load_seq={read_loads(spark, folder)[-1].load_seq}"
    loaded = read_loaded(spark, folder).where("status = 'accepted'")
    return Star(
        fact=loaded.drop("fare_text", "raw_text", "reject_reason", "status", "load_seq"),
        lines=spark.read.schema(LINE_SCHEMA).parquet(f"{last}/dim_line"),
        stations=spark.read.schema(STATION_SCHEMA).parquet(f"{last}/dim_station"),
        passenger_types=spark.read.schema(PASSENGER_TYPE_SCHEMA).parquet(f"{last}/dim_passenger_type"),
        dates=spark.read.schema(DATE_SCHEMA).parquet(f"{last}/dim_date"),
    )


def write_extract_csv(df: DataFrame, path: str) -> None:
    """Delimited text with a header, one file per task."""
    money = [field.name for field in df.schema.fields if field.dataType == MONEY]
    plain = df.withColumns({name: F.col(name).cast("string") for name in money}) if money else df
    (
        plain.write.option("header", True)
        .option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def refresh_statistics(spark: SparkSession, table: str, histograms: bool = True) -> None:
    """Size, row count and column statistics of a catalogue table, by default with equi-height histograms.

    Catalyst uses them for selectivities and join orders when ``spark.sql.cbo.enabled`` is on.
    """
    key = "spark.sql.statistics.histogram.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, str(histograms).lower())
    try:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
    finally:
        spark.conf.set(key, before)


def table_statistics(spark: SparkSession, table: str) -> DataFrame:
    """Per column: column_name, row_count of the table, null_count, whether it has a histogram, longest value."""
    size = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Statistics'").first()["data_type"]
    rows = int(size.split(",")[1].split()[0])
    found = []
    for field in spark.table(table).schema.fields:
        known = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {table} `{field.name}`").collect()}
        found.append((field.name, rows, int(known["num_nulls"]), known.get("histogram", "NULL") != "NULL", int(known["max_col_len"])))
    return spark.createDataFrame(
        found, "column_name string, row_count bigint, null_count bigint, has_histogram boolean, longest_bytes bigint"
    )
