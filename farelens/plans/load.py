"""Raw text to star schema: seed dimensions, convert rows, set the bad ones aside with a reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.functions import text
from farelens.functions.dates import date_dimension, observed_days
from farelens.functions.numeric import fare_total
from farelens.operators.lookups import same_or_both_blank, spread_blanks
from farelens.operators.upsert import append_absent, insert_absent, number_rows
from farelens.plans import rollups
from farelens.schemas import (
    DIGITAL_TYPES,
    FACT_SCHEMA,
    LINE_SCHEMA,
    PASSENGER_TYPE_SCHEMA,
    RAW_COLUMNS,
    STATION_SCHEMA,
    Star,
)
from farelens.session import stage
from farelens.sources import tables
from farelens.sources.extracts import CORRUPT

FACT_COLUMNS = [field.name for field in FACT_SCHEMA.fields]


def _numbered(new: DataFrame, existing: DataFrame | None, key: str, name: str) -> DataFrame:
    """Number the rows ``existing`` lacks, after its largest id."""
    if existing is None:
        return number_rows(new, key, name)
    absent = new.join(existing.select(name), name, "left_anti")
    start = F.coalesce(existing.agg(F.max(key)).scalar(), F.lit(0))
    return number_rows(absent, key, name, start)


def seed_lines(raw: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Lines named in the raw rows. Of several colour codes the smallest wins."""
    lines = (
        raw.where(F.col("Line").isNotNull())
        .groupBy(F.col("Line").alias("line_name"))
        .agg(F.min("LineCC").alias("line_colour_cc"))
    )
    return _numbered(lines, existing, "line_id", "line_name").select(
        "line_id", "line_name", "line_colour_cc", F.lit(True).alias("is_active")
    )


def seed_passenger_types(
    raw: DataFrame, digital: Sequence[str] = DIGITAL_TYPES, existing: DataFrame | None = None
) -> DataFrame:
    types = raw.where(F.col("PrType").isNotNull()).select(F.col("PrType").alias("passenger_type")).distinct()
    return _numbered(types, existing, "passenger_type_id", "passenger_type").select(
        "passenger_type_id", "passenger_type", F.col("passenger_type").isin(list(digital)).alias("is_digital")
    )


def seed_stations(raw: DataFrame, lines: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Stations seen as origins of a known line; of several labels and lines the smallest wins.

    Codes and lines are reduced to their distinct pairs before the line look-up.
    """
    pairs = (
        raw.select(text.station_code("Sta").alias("station_id"), "Sta", "Line")
        .where(F.col("station_id").isNotNull() & F.col("Line").isNotNull())
        .distinct()
    )
    known = pairs.join(lines.select("line_id", "line_name"), pairs["Line"] == lines["line_name"])
    stations = (
        known.groupBy("station_id")
        .agg(F.min(F.struct(F.concat(F.lit("Station "), "Sta").alias("name"), "line_id")).alias("first"))
        .select(
            "station_id",
            F.col("first.name").alias("station_name"),
            F.col("first.line_id").alias("line_id"),
            F.lit(False).alias("is_interchange"),
        )
    )
    if existing is not None:
        stations = stations.join(existing.select("station_id"), "station_id", "left_anti")
    return stations


def key_combinations(raw: DataFrame) -> DataFrame:
    """Distinct dimension keys of the raw rows with their date range.

    All seeds can be drawn from this instead of the raw rows, which are then scanned only once.
    Times that cannot be read are left to the reject rule; malformed lines seed nothing.
    """
    day = text.timestamp("InsertionDateTime").cast("date")
    if CORRUPT in raw.columns:
        raw = raw.where(F.col(CORRUPT).isNull())
    return raw.groupBy("Sta", "Line", "LineCC", "PrType").agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )


def seed_dates(keys: DataFrame) -> DataFrame:
    """Every day of the observed range, from ``key_combinations``."""
    return date_dimension(observed_days(keys, "first_day", "last_day"))


def write_dimensions(
    raw: DataFrame, folder: str, digital: Sequence[str], known: Star | None = None
) -> DataFrame:
    """Seed the four dimensions from a single scan of the raw rows and write them to ``folder``.

    Rows of ``known`` keep their keys and attributes; new ones are numbered after the largest key, and
    the dates run from the first to the last day of both. Returns the raw rows' ``key_combinations``.
    """
    spark = raw.sparkSession
    keys = stage(key_combinations(raw), "key-combinations")

    def write(new: DataFrame, old: DataFrame | None, key: str, name: str) -> None:
        tables.write_dimension(new if old is None else insert_absent(old, new, key), f"{folder}/{name}")

    old = known or Star(*[None] * 5)
    write(seed_lines(keys, old.lines), old.lines, "line_name", "dim_line")
    lines = spark.read.schema(LINE_SCHEMA).parquet(f"{folder}/dim_line")
    write(seed_passenger_types(keys, digital, old.passenger_types), old.passenger_types, "passenger_type", "dim_passenger_type")
    write(seed_stations(keys, lines, old.stations), old.stations, "station_id", "dim_station")
    span = keys.select("first_day", "last_day")
    if old.dates is not None:
        span = span.unionByName(old.dates.agg(F.min("date_key").alias("first_day"), F.max("date_key").alias("last_day")))
    tables.write_dimension(seed_dates(span), f"{folder}/dim_date")
    return keys


def convert_against(raw: DataFrame, folder: str, keep_text: bool = False) -> DataFrame:
    """``convert`` against written dimensions, whose true size the look-ups then know."""
    read = raw.sparkSession.read
    return convert(
        raw,
        read.schema(LINE_SCHEMA).parquet(f"{folder}/dim_line"),
        read.schema(PASSENGER_TYPE_SCHEMA).parquet(f"{folder}/dim_passenger_type"),
        read.schema(STATION_SCHEMA).parquet(f"{folder}/dim_station"),
        keep_text,
    )


def convert_once_each(raw: DataFrame, folder: str) -> DataFrame:
    """``convert_against`` with one accepted row per id; the others of an id are rejects, ``duplicate_id``.

    The first record by time, then by its text, is accepted. Which raw ids repeat is counted first, from the
    ids alone; only rows with such an id are shuffled, and only if there are any. Equal records are counted
    before they move, so a record that arrives a million times is one row.
    """
    several = raw.where(F.col("trx_id").isNotNull()).groupBy("trx_id").agg(F.count("*").alias("n")).where("n > 1")
    several = stage(several.select(F.col("trx_id").alias("repeated_id")), "repeated-ids")
    if several.isEmpty():
        return convert_against(raw, folder)
    once = convert_against(raw.join(several, raw["trx_id"] == several["repeated_id"], "left_anti"), folder)
    repeated = convert_against(raw.join(several, raw["trx_id"] == several["repeated_id"], "left_semi"), folder, keep_text=True)
    return once.unionByName(_first_of_each_id(repeated).select(*once.columns))


def _first_of_each_id(rows: DataFrame) -> DataFrame:
    """``rows`` with all but the first otherwise good row of each id rejected."""
    good = F.col("reject_reason").isNull()
    alike = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    order = F.struct("txn_timestamp", "raw_text", "line_id", "passenger_type_id")
    alike = alike.withColumn("place", F.when(good, order))
    first = alike.where(good).groupBy(F.col("transaction_id").alias("id")).agg(F.min("place").alias("first"))
    judged = alike.join(first, same_or_both_blank(F.col("transaction_id"), F.col("id")), "left")
    stays = good & F.col("place").eqNullSafe(F.col("first"))
    # The row that stays, then its copies: one accepted, the rest rejected.
    numbered = judged.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).withColumn(
        "reject_reason", F.when(good & ~(stays & (F.col("copy") == 1)), "duplicate_id").otherwise(F.col("reject_reason"))
    )
    return numbered.withColumn("raw_text", F.when(F.col("reject_reason").isNotNull(), F.col("raw_text")))


def _reject_reason() -> Column:
    """First rule a row breaks, in fixed order; blank when it breaks none."""
    dest_given = F.nullif(F.col("dest_text"), F.lit("")).isNotNull()
    return (
        F.when(F.col(CORRUPT).isNotNull(), "record")
        .when(F.col("transaction_id").isNull(), "transaction_id")
        .when(F.col("fare_amount").isNull(), "fare")
        .when(F.col("origin_station_id").isNull(), "origin")
        .when(F.col("dest_station_id").isNull() & dest_given, "destination")
        .when(F.col("txn_timestamp").isNull(), "timestamp")
        .when(F.col("line_id").isNull(), "line")
        .when(F.col("passenger_type_id").isNull(), "passenger_type")
        .when(F.col("dest_station_id").isNotNull() & F.col("known_dest").isNull(), "destination_fk")
    )


def convert(
    raw: DataFrame, star_lines: DataFrame, passenger_types: DataFrame, stations: DataFrame, keep_text: bool = False
) -> DataFrame:
    """Every raw row, typed, with ``reject_reason`` (blank = accepted), the fare as text, and the whole
    raw record as text where it is rejected (everywhere with ``keep_text``).

    One pass over the raw rows with three left look-ups, so no row is lost. Should the stations
    outgrow a broadcast, blank destinations are spread over the tasks and AQE splits a hot code.
    """
    if CORRUPT not in raw.columns:
        raw = raw.withColumn(CORRUPT, F.lit(None).cast("string"))
    typed = raw.select(
        F.col("trx_id").alias("transaction_id"),
        CORRUPT,
        F.coalesce(CORRUPT, F.to_json(F.struct("trx_id", *RAW_COLUMNS))).alias("raw_text"),
        text.timestamp("InsertionDateTime").alias("txn_timestamp"),
        text.station_code("Sta").alias("origin_station_id"),
        text.optional_code("Dest").alias("dest_station_id"),
        F.col("Dest").alias("dest_text"),
        "Line",
        "PrType",
        F.col("TxT").alias("txn_type"),
        F.col("FarT").alias("fare_type"),
        text.fare("Value").alias("fare_amount"),
        F.col("Value").alias("fare_text"),
        F.col("TrxDetail").alias("txn_detail"),
    ).withColumn("txn_date", F.col("txn_timestamp").cast("date"))
    lines = star_lines.select("line_id", F.col("line_name").alias("Line"))
    types = passenger_types.select("passenger_type_id", F.col("passenger_type").alias("PrType"))
    known = stations.select(F.col("station_id").alias("known_dest"))
    return (
        typed.join(lines, "Line", "left")
        .join(types, "PrType", "left")
        .join(known, spread_blanks(F.col("dest_station_id"), F.col("transaction_id")) == F.col("known_dest"), "left")
        .withColumn("reject_reason", _reject_reason())
        .select(
            *FACT_COLUMNS,
            "fare_text",
            F.when(F.col("reject_reason").isNotNull() | F.lit(keep_text), F.col("raw_text")).alias("raw_text"),
            "reject_reason",
        )
    )


def accepted(converted: DataFrame, strict: bool = False) -> DataFrame:
    """The fact rows. ``strict`` fails the job on the first reject instead of dropping it."""
    if strict:
        problem = F.concat(F.lit("rejected row: "), F.coalesce(F.col("reject_reason"), F.lit("")))
        converted = converted.where(F.assert_true(F.col("reject_reason").isNull(), problem).isNull())
    return converted.where(F.col("reject_reason").isNull()).select(*FACT_COLUMNS)


def rejects(converted: DataFrame) -> DataFrame:
    return converted.where(F.col("reject_reason").isNotNull()).select(
        "transaction_id", "reject_reason", "fare_text", "raw_text"
    )


def rejects_by_reason(converted: DataFrame) -> DataFrame:
    """Rejected rows per reason, and the fare text of the row with the smallest id as an example."""
    return (
        rejects(converted)
        .groupBy("reject_reason")
        .agg(
            F.count("*").alias("rejected_rows"),
            F.count_distinct("fare_text").alias("distinct_fare_texts"),
            F.min_by("fare_text", "transaction_id").alias("example_fare_text"),
        )
    )


def reconcile(converted: DataFrame) -> DataFrame:
    """One row: raw = accepted + rejected."""
    good = F.col("reject_reason").isNull()
    return converted.agg(
        F.count("*").alias("raw_rows"),
        F.count_if(good).alias("accepted_rows"),
        F.count_if(~good).alias("rejected_rows"),
        fare_total(F.when(good, F.col("fare_amount"))).alias("accepted_revenue"),
    ).withColumn("is_reconciled", F.col("raw_rows") == F.col("accepted_rows") + F.col("rejected_rows"))


def load_star(
    raw: DataFrame,
    folder: str,
    digital: Sequence[str] = DIGITAL_TYPES,
    strict: bool = False,
    replace_months: bool = False,
    cluster: bool = False,
    row_group_bytes: int | None = None,
) -> Star:
    """Load raw rows into the star tables under ``folder``, as often as rows arrive.

    Dimensions keep their keys and gain what is new. Rows already loaded (same id, same month) are not
    added again, so a chunk or a whole extract may come twice; with ``replace_months`` the load's months
    take the place of what earlier loads held of them. Of rows that share an id inside one load the first is
    accepted. Rejects stay with their load until a later load accepts or rejects the same record.

    ``cluster`` orders each month over origin and destination, so that a filter on either station skips most
    row groups. It costs a load one more copy of its rows, written once and read twice.

    A load writes folders of its own, the accepted and rejected rows side by side in one pass and the sums
    that the serving views add up, and becomes visible by the last step, a line in the table of loads; one
    that fails leaves the star as it was.
    """
    spark = raw.sparkSession
    loads = tables.read_loads(spark, folder)
    number = max((load.load_seq for load in loads), default=0) + 1
    known = tables.read_star(spark, folder) if loads else None
    dimensions = f"{folder}/dimensions/load_seq={number}"
    keys = write_dimensions(raw, dimensions, digital, known)
    converted = convert_once_each(raw, dimensions)
    if strict:
        rows = accepted(converted, strict=True).withColumns(
            {name: F.lit(None).cast("string") for name in ("fare_text", "raw_text", "reject_reason")}
        )
    else:
        rows = converted
    if known is not None and not replace_months:
        rows = _not_loaded(rows, known.fact, keys)
    status = F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected")
    own = tables.load_folder(folder, number)
    rows, bounds = rows.withColumn("status", status), None
    if cluster:
        rows = stage(rows, "load-rows")
        bounds = tables.station_bounds(spark.read.schema(STATION_SCHEMA).parquet(f"{dimensions}/dim_station"))
    tables.write_fact(rows, own, ("status",), dynamic=False, station_bounds=bounds, row_group_bytes=row_group_bytes)
    months = tables.months_of_load(spark, own) if replace_months else []
    tables.commit_load(spark, folder, number, months, rollups.write_rollups(spark, folder, number))
    return rollups.read_star(spark, folder)


def _not_loaded(rows: DataFrame, fact: DataFrame, keys: DataFrame) -> DataFrame:
    """Rejected rows, and the accepted ones whose id their month does not hold yet.

    ``keys`` bound the months, so the rows needn't be converted once more to learn them. Rejects take part
    under one of 1,024 names that are no month, so that all rows go through one conversion.
    """
    no_month = F.concat(F.lit("-"), F.pmod(F.xxhash64("raw_text"), F.lit(1024)).cast("string"))
    month = F.when(F.col("reject_reason").isNull(), tables.month_of(F.col("txn_date"))).otherwise(no_month)
    every_month = F.sequence(F.trunc("first_day", "month"), F.trunc("last_day", "month"), F.expr("INTERVAL 1 MONTH"))
    touched = keys.where("first_day IS NOT NULL").select(F.explode(every_month).alias("month"))
    fresh = append_absent(
        fact.select("transaction_id", tables.MONTH),
        rows.withColumn(tables.MONTH, month),
        partition=tables.MONTH,
        touched=touched.select(tables.month_of(F.col("month")).alias(tables.MONTH)).distinct(),
    )
    return fresh.select(*rows.columns)


def open_rejects(spark, folder: str) -> DataFrame:
    """Rejected records no later load has dealt with: load_seq, transaction_id, reject_reason, raw_text.

    A record is known by its id, without one by its whole text.
    """
    loaded = tables.read_loaded(spark, folder)
    identity = F.coalesce(F.concat(F.lit("id "), F.col("transaction_id").cast("string")), F.col("raw_text"))
    bad = loaded.where("status = 'rejected'").withColumn("identity", identity)
    last = bad.groupBy("identity").agg(F.max("load_seq").alias("last_seq"))
    # Staged, so that its true size decides how the accepted rows are searched: only their ids and loads are read,
    # and only rows with a rejected id are grouped.
    ids = stage(bad.where("transaction_id IS NOT NULL").select("transaction_id").distinct(), "rejected-ids")
    good = loaded.where("status = 'accepted'").select("transaction_id", "load_seq").join(ids, "transaction_id", "left_semi")
    good = good.groupBy(F.col("transaction_id").alias("good_id")).agg(F.max("load_seq").alias("good_seq"))
    return (
        bad.join(last, "identity")
        .where("load_seq = last_seq")
        .join(good, F.col("transaction_id") == F.col("good_id"), "left")
        # A repeated id was accepted once by its own load, which doesn't settle its other records.
        .where("good_seq IS NULL OR good_seq < load_seq OR good_seq = load_seq AND reject_reason = 'duplicate_id'")
        .select("load_seq", "transaction_id", "reject_reason", "fare_text", "raw_text")
    )
