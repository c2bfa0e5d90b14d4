"""Registered queries: name -> function of the session and a table folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.functions.dates import date_dimension, days_between, observed_days, report_calendar
from farelens.functions.numeric import fare_total
from farelens.operators.sampling import exact_sample, stratified_sample
from farelens.operators.upsert import append_absent, insert_absent
from farelens.plans import load, marts, quality, report
from farelens.plans.measures import catalogue, evaluate
from farelens.schemas import EXTRACT_COLUMNS, RAW_SCHEMA
from farelens.session import fresh_path, stage
from farelens.sources import extracts, tables
from farelens.streaming.landing import land_new_files
from farelens.workload import standins as st

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries; the oracle SQL states the same values.
OD_MIN_JOURNEYS = 30
DAILY_TARGET = 1_250_000
AVG_TICKET_TARGET = "38000.00"
# The report's calendar range, moved to the years of the test data.
FIXED_RANGE = ("1997-04-28", "1997-08-04")
DATE_SLICE = ("1997-01-01", "1998-12-31")
LINE_SLICE = ["ASIA", "EUROPE"]
TYPE_SLICE = ["A", "R"]
STATION_SLICE = ["Supplier#000000003", "Supplier#000000007"]
SELECTION = {"line_name": LINE_SLICE, "ticket_type": TYPE_SLICE, "date": DATE_SLICE}
AREAS = [f"NATION_{number}" for number in range(25)]
FARE_MEASURES = catalogue(st.FARE_DIGITAL)


def present(df: DataFrame, digits: Mapping[str, int] | None = None) -> DataFrame:
    """Round the named columns half up; money as double and every whole number as bigint."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if digits and field.name in digits:
            column = F.round(column, digits[field.name])
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _mart(build: Callable, star: Callable = st.fare_star, *args, **options) -> Query:
    return lambda spark, sf_dir: present(build(star(spark, sf_dir), *args, **options))


def _report(build: Callable, digits: Mapping[str, int] | None = None, **options) -> Query:
    return lambda spark, sf_dir: present(build(st.fare_model(spark, sf_dir), **options), digits)


RATIO_DIGITS = {
    "avg_ticket_value": 4,
    "daily_avg_revenue": 2,
    "revenue_30d_rolling_avg": 2,
    "revenue_share": 6,
    "digital_adoption": 6,
    "daily_revenue_target": 2,
}


def _short_calendar(names: list[str], group_by=()) -> Query:
    """Measures over a calendar that lacks some days with sales."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        model = st.fare_model(spark, sf_dir)
        model = replace(model, calendar=days_between(spark, *FIXED_RANGE))
        return present(evaluate(model, names, group_by, None, FARE_MEASURES), RATIO_DIGITS)

    return run


def _measures(names: list[str], group_by=(), filters=None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = evaluate(st.fare_model(spark, sf_dir), names, group_by, filters, FARE_MEASURES)
        return present(rows, RATIO_DIGITS)

    return run


# --- sources and sinks -------------------------------------------------------------------------


def land_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "extract-csv")
    tables.write_extract_csv(st.raw_extract(spark, sf_dir), path)
    landed = extracts.land_raw(spark, path)
    return landed.drop("ingested_at", extracts.CORRUPT)


def chunked_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows arriving as several files, one of malformed lines, landed chunk by chunk."""
    inbox, raw, state = (fresh_path(spark, f"chunked-{part}") for part in ("inbox", "raw", "state"))
    tables.write_extract_csv(st.raw_extract(spark, sf_dir).repartition(6), f"{inbox}/whole")
    short = st.raw_landing(spark, sf_dir).where("trx_id % 131 = 0").selectExpr("concat(trx_id, ',short') AS value")
    header = spark.createDataFrame([(",".join(EXTRACT_COLUMNS),)], "value string")
    header.union(short).coalesce(1).write.text(f"{inbox}/short")
    land_new_files(spark, f"{inbox}/*", raw, state, files_per_chunk=2).awaitTermination()
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(extracts.CORRUPT, T.StringType())])
    landed = spark.read.schema(schema).parquet(raw)
    return landed.drop("ingested_at")


def land_without_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without an id column, landed again with a new file beside them: rows the second landing adds."""
    inbox = fresh_path(spark, "without-ids")
    rows = st.raw_extract(spark, sf_dir).drop("transaction_id")
    first = F.col("InsertionDateTime") < "2024-01-16"
    columns = EXTRACT_COLUMNS[1:]
    tables.write_extract_csv(rows.where(first).repartition(3), f"{inbox}/first")
    before = stage(extracts.land_raw(spark, f"{inbox}/*", columns), "landed")
    tables.write_extract_csv(rows.where(~first).unionByName(rows.where(~first)).repartition(2), f"{inbox}/second")
    again = extracts.land_raw(spark, f"{inbox}/*", columns)
    added = append_absent(before, again, key="trx_id")
    return present(added.groupBy("Line").agg(F.count("*").alias("added_rows"), F.count_distinct("trx_id").alias("ids")))


def import_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line and station files written and read back, with each station's line target."""
    star = st.fare_star(spark, sf_dir)
    targets = _targets(star.lines)
    line_path, station_path = fresh_path(spark, "line-csv"), fresh_path(spark, "station-csv")
    tables.write_extract_csv(
        star.lines.join(targets, "line_name").select(
            "line_id", "line_name", "line_colour_cc", "revenue_share_target_pct"
        ),
        line_path,
    )
    tables.write_extract_csv(
        star.stations.join(star.lines.select("line_id", "line_name"), "line_id").select(
            "station_id", "station_name", "line_id", "line_name", "is_interchange"
        ),
        station_path,
    )
    lines = extracts.read_lines(spark, line_path).drop("line_name")
    return present(extracts.read_stations(spark, station_path).join(lines, "line_id"))


def serving_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three views, read by name: rows and revenue of each."""
    marts.register_views(st.fare_star(spark, sf_dir))
    parts = [
        f"SELECT '{name}' AS view_name, count(*) AS row_count, sum({column}) AS revenue FROM {name}"
        for name, column in {
            "vw_daily_revenue_trend": "daily_revenue",
            "vw_line_revenue_share": "total_revenue",
            "vw_station_performance": "revenue",
        }.items()
    ]
    return present(spark.sql(" UNION ALL ".join(parts)))


def import_flat_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "flat-csv")
    flat = marts.flat_extract(st.event_star(spark, sf_dir, staged=True))
    tables.write_extract_csv(flat, path)
    return present(extracts.import_flat_extract(spark, path))


def load_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(load.accepted(st.converted(spark, sf_dir)))


def persisted_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load, write, read back: rows and revenue per month folder and line."""
    folder = fresh_path(spark, "star")
    star = load.load_star(st.raw_landing(spark, sf_dir), folder, st.EVENT_DIGITAL)
    by_month = star.fact.groupBy(tables.MONTH, "line_id").agg(
        F.count("*").alias("footfall"), fare_total().alias("revenue")
    )
    named = by_month.join(star.lines.select("line_id", "line_name"), "line_id").drop("line_id")
    return present(named)


def _load_days(spark: SparkSession, sf_dir: str, parts, change=None):
    """Loads the raw rows of each (first, last) part into one star; ``change`` alters a part's rows."""
    folder = fresh_path(spark, "star")
    raw = st.raw_landing(spark, sf_dir)
    for number, (first, last) in enumerate(parts):
        rows = raw.where(F.col("InsertionDateTime").between(first, last))
        star = load.load_star(change(rows, number) if change else rows, folder, st.EVENT_DIGITAL)
    return star, folder


def load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two periods, the second with a line that sorts first: rows and revenue per line name and key."""

    def renamed(rows: DataFrame, number: int) -> DataFrame:
        new = F.when(F.expr("trx_id % 7 = 0"), "A line").otherwise(F.col("Line"))
        return rows.withColumn("Line", new) if number else rows

    star, _ = _load_days(spark, sf_dir, [("", "2024-01-16"), ("2024-01-16", "z")], renamed)
    totals = star.fact.groupBy("line_id").agg(F.count("*").alias("footfall"), fare_total().alias("revenue"))
    named = totals.join(star.lines.select("line_id", "line_name"), "line_id")
    first, last = (star.dates.agg(bound("date_key")).scalar() for bound in (F.min, F.max))
    return present(named.withColumns({"first_day": first, "last_day": last}))


def load_partial_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table in two parts that cut a month, then one that overlaps both: rows and revenue per day."""
    parts = [("", "2024-01-10"), ("2024-01-10", "z"), ("2024-01-05", "2024-01-15")]
    star, _ = _load_days(spark, sf_dir, parts)
    return present(star.fact.groupBy("txn_date").agg(F.count("*").alias("footfall"), fare_total().alias("revenue")))


def load_corrected_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows again with the fares of ``N/A`` and some times mended: rejects left, and accepted rows."""

    def mended(rows: DataFrame, number: int) -> DataFrame:
        if not number:
            return rows
        fare = F.when(F.col("Value") == "N/A", "1.00").otherwise(F.col("Value"))
        time = F.when(F.expr("trx_id % 2 = 0 AND InsertionDateTime = 'not-a-time'"), "2024-01-07 00:00:00")
        return rows.withColumns({"Value": fare, "InsertionDateTime": F.coalesce(time, "InsertionDateTime")})

    star, folder = _load_days(spark, sf_dir, [("", "z"), ("", "z")], mended)
    left = load.open_rejects(spark, folder).groupBy(F.col("reject_reason").alias("outcome")).agg(F.count("*").alias("row_count"))
    good = star.fact.agg(F.count("*").alias("row_count")).select(F.lit("accepted").alias("outcome"), "row_count")
    return present(left.unionByName(good))


def load_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that repeat inside one load: open rejects per reason, and what was accepted."""
    folder = fresh_path(spark, "star")
    star = load.load_star(st.repeated_landing(spark, sf_dir), folder, st.EVENT_DIGITAL)
    left = load.open_rejects(spark, folder).groupBy(F.col("reject_reason").alias("outcome"))
    left = left.agg(F.count("*").alias("row_count"), F.lit(None).cast("decimal(20,2)").alias("revenue"))
    good = star.fact.agg(F.count("*").alias("row_count"), fare_total().alias("revenue"))
    return present(left.unionByName(good.select(F.lit("accepted").alias("outcome"), "row_count", "revenue")))


def load_duplicates_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, folder = st.repeated_landing(spark, sf_dir), fresh_path(spark, "dimensions")
    load.write_dimensions(raw, folder, st.EVENT_DIGITAL)
    return present(load.reconcile(load.convert_once_each(raw, folder)))


def serving_views_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three views after appends, a replay and a replaced month, read by name from the loads' sums."""
    marts.register_views(st.maintained_star(spark, sf_dir))
    return present(
        spark.sql("""
        SELECT 'trend' AS view_name, cast(txn_date AS string) AS member, cast(NULL AS string) AS line_name,
               daily_footfall AS footfall, daily_revenue AS revenue, revenue_30d_rolling_avg AS figure FROM vw_daily_revenue_trend
        UNION ALL SELECT 'lines', line_name, NULL, total_footfall, total_revenue, revenue_share_pct FROM vw_line_revenue_share
        UNION ALL SELECT 'stations', station_name, line_name, footfall, revenue, avg_ticket_value FROM vw_station_performance""")
    )


def stations_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct stations per line from merged sketches next to the exact count, for a range of days."""
    star = st.maintained_star(spark, sf_dir)
    days = {"first": "2024-01-05", "last": "2024-02-12"}
    exact = marts.stations_covered(star, ["line_id"], **days)
    sketched = marts.stations_covered(star, ["line_id"], **days, approximate=True).withColumnRenamed("stations_covered", "estimate")
    off = F.abs(F.col("estimate") - F.col("stations_covered")) <= 0.08 * F.col("stations_covered")  # five standard errors
    named = exact.join(sketched, "line_id").join(star.lines.select("line_id", "line_name"), "line_id")
    return present(named.select("line_name", "stations_covered", off.alias("within_bound")))


STORED_SELECTION = {"ticket_type": ["purchase", "click"], "date": ("2024-01-10", "2024-02-20")}


def dashboard_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All visuals under a selection, answered from the sums that the loads have stored."""
    model = report.report_model(st.maintained_star(spark, sf_dir))
    return present(report.all_datasets(model, STORED_SELECTION), {"value": 2})


def slice_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slicers on the calendar's attributes over a stored star: a quarter's second month, weekdays only."""
    model = replace(report.report_model(st.maintained_star(spark, sf_dir)), rollups=())
    filters = {"year": [2024], "month_name": ["Feb"], "is_weekend": [False]}
    return present(evaluate(model, report.KPI_MEASURES, ["line_name"], filters), RATIO_DIGITS)


def slice_station_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One station as destination, then as origin, over a fact ordered along both."""
    folder = fresh_path(spark, "star")
    star = load.load_star(st.raw_landing(spark, sf_dir), folder, st.EVENT_DIGITAL, cluster=True)
    parts = []
    for side in ("origin_station_id", "dest_station_id"):
        rows = star.fact.where(F.col(side) == 7).agg(F.count("*").alias("footfall"), fare_total().alias("revenue"))
        parts.append(rows.select(F.lit(side).alias("side"), "footfall", "revenue"))
    return present(parts[0].unionByName(parts[1]))


def append_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replaying a load whose first part is already there adds only the rest."""
    fact = st.event_fact(spark, sf_dir).withColumn(tables.MONTH, tables.month_of(F.col("txn_date")))
    loaded = fact.where(F.col("txn_date") < F.lit("2024-01-16").cast("date"))
    fresh = append_absent(loaded, fact, partition=tables.MONTH)
    return present(
        fresh.groupBy("txn_date").agg(F.count("*").alias("added_rows"), fare_total().alias("added_revenue"))
    )


# --- load --------------------------------------------------------------------------------------


def seed_dim_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(load.seed_lines(st.raw_landing(spark, sf_dir)))


def seed_dim_passenger_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(load.seed_passenger_types(st.raw_landing(spark, sf_dir), st.EVENT_DIGITAL))


def seed_dim_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = st.raw_landing(spark, sf_dir)
    return present(load.seed_stations(raw, load.seed_lines(raw)))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(date_dimension(observed_days(st.fare_fact(spark, sf_dir), "txn_date")))


def dim_date_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed calendar with each day's totals; days without sales stay."""
    calendar = report_calendar(days_between(spark, *FIXED_RANGE))
    daily = marts.daily_totals(st.fare_star(spark, sf_dir)).where(F.col("txn_date").between(*map(F.lit, FIXED_RANGE)))
    joined = calendar.join(daily, calendar["date_key"] == daily["txn_date"], "left").drop("txn_date")
    return present(joined)


def upsert_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations known from the first day, then every station the whole table brings in."""
    raw = st.raw_landing(spark, sf_dir)
    lines = load.seed_lines(raw)
    first_day = raw.where(F.col("InsertionDateTime") < "2024-01-02")
    known = load.seed_stations(first_day, lines).withColumn("is_interchange", F.lit(True))
    return present(insert_absent(known, load.seed_stations(raw, lines), "station_id"))


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With malformed lines and ids that are no numbers among the faults."""
    return present(load.rejects_by_reason(st.converted(spark, sf_dir, faulty=True)))


def load_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(load.reconcile(st.converted(spark, sf_dir)))


# --- quality -----------------------------------------------------------------------------------


def stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample's size and revenue per line and hour; two strata have rates of their own."""
    fact = st.event_fact(spark, sf_dir)
    strata = [F.col("line_id"), F.hour("txn_timestamp")]
    sample = stratified_sample(fact, "transaction_id", 0.2, strata, {(3, 5): 0.5, (2, 7): 0.00004})
    return _sampled(sample)


def _event_strata() -> dict:
    return {"line": F.col("line_id"), "hour": F.hour("txn_timestamp")}


def sample_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of all rows, each stratum with exactly its quota: size and revenue per line and hour."""
    return _sampled(exact_sample(st.event_fact(spark, sf_dir), "transaction_id", _event_strata(), 0.2))


def sample_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the exact sample's profiles from the full data's."""
    fact = st.event_fact(spark, sf_dir)
    sample = exact_sample(fact, "transaction_id", _event_strata(), 0.2)
    found = quality.sample_distance(fact, sample)
    return present(found.withColumns({name: F.round(name, 6) for name in ("chi_square", "ks_distance")}))


def sample_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue estimated from the exact sample, with its standard error."""
    fact = st.event_fact(spark, sf_dir)
    found = quality.estimated_revenue(fact, exact_sample(fact, "transaction_id", _event_strata(), 0.2))
    rounded = {name: F.round(name, 2) for name in ("revenue", "estimated_revenue", "standard_error")}
    return present(found.withColumns(rounded))


def measure_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten measures by line and ticket type with every total, each evaluated at its own level."""
    rows = evaluate(
        st.fare_model(spark, sf_dir), list(FARE_MEASURES), ["line_name", "ticket_type"], {"date": DATE_SLICE}, FARE_MEASURES, totals=True
    )
    return present(rows, RATIO_DIGITS)


def catalogue_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as a catalogue table with refreshed statistics: what the catalogue then knows of each column."""
    name = "farelens_" + uuid.uuid4().hex
    st.fare_fact(spark, sf_dir).write.option("path", fresh_path(spark, "catalogue")).saveAsTable(name)
    try:
        tables.refresh_statistics(spark, name)
        known = stage(tables.table_statistics(spark, name), "statistics")
    finally:
        spark.sql(f"DROP TABLE {name}")
    return known


def _sampled(sample: DataFrame) -> DataFrame:
    return present(
        sample.groupBy("line_id", F.hour("txn_timestamp").alias("hour_of_day")).agg(
            F.count("*").alias("sampled"), fare_total().alias("revenue")
        )
    )


def sample_coded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample over ids that carry the hour in their last digits."""
    fact = st.event_fact(spark, sf_dir)
    coded = fact.withColumn("transaction_id", F.expr("transaction_id * 10000 + hour(txn_timestamp)"))
    return _sampled(stratified_sample(coded, "transaction_id", 0.2))


def sample_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = st.event_fact(spark, sf_dir)
    return present(quality.sample_validation(fact, stratified_sample(fact, "transaction_id", 0.2)))


def sample_validation_worst(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = st.event_fact(spark, sf_dir)
    sample = stratified_sample(fact, "transaction_id", 0.2)
    return present(quality.worst_difference(quality.sample_validation(fact, sample)))


def share_vs_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = st.fare_star(spark, sf_dir)
    return present(quality.share_against_target(star, _targets(star.lines)))


def _targets(lines: DataFrame) -> DataFrame:
    target = F.when(F.col("line_id") == 0, 40.0).otherwise(15.0)
    return lines.select("line_name", target.alias("revenue_share_target_pct"))


def flow_matrix_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(report.flow_matrix_wide(_area_star(spark, sf_dir), AREAS))


def _staged_event_star(spark: SparkSession, sf_dir: str):
    return st.event_star(spark, sf_dir, staged=True)


def _area_star(spark: SparkSession, sf_dir: str):
    return st.fare_star(spark, sf_dir, "n_name")


QUERIES: dict[str, Query] = {
    # sources and sinks
    "land_raw": land_raw,
    "land_without_ids": land_without_ids,
    "chunked_landing": chunked_landing,
    "import_flat_extract": import_flat_extract,
    "import_dimensions": import_dimensions,
    "serving_views": serving_views,
    "flat_extract": _mart(marts.flat_extract, _staged_event_star),
    "load_fact": load_fact,
    "persisted_star": persisted_star,
    "append_replay": append_replay,
    "load_twice": load_twice,
    "load_partial_month": load_partial_month,
    "load_corrected_replay": load_corrected_replay,
    "load_duplicates": load_duplicates,
    "load_duplicates_reconciled": load_duplicates_reconciled,
    "serving_views_maintained": serving_views_maintained,
    "stations_sketched": stations_sketched,
    "catalogue_statistics": catalogue_statistics,
    # load
    "seed_dim_line": seed_dim_line,
    "seed_dim_passenger_type": seed_dim_passenger_type,
    "seed_dim_station": seed_dim_station,
    "dim_date": dim_date,
    "dim_date_fixed": dim_date_fixed,
    "upsert_dim": upsert_dim,
    "load_rejects": load_rejects,
    "load_reconciliation": load_reconciliation,
    "integrity_report": _mart(quality.integrity_report, st.faulty_star),
    # analysis results and serving views
    "headline_kpis": _mart(marts.headline_kpis),
    "daily_revenue_rolling": lambda spark, sf_dir: present(
        marts.daily_revenue_rolling(st.fare_star(spark, sf_dir)), {"revenue_30d_rolling_avg": 4}
    ),
    "daily_revenue_trend": _mart(marts.daily_revenue_trend),
    "line_contribution": _mart(marts.line_contribution),
    "line_revenue_share": _mart(marts.line_revenue_share),
    "passenger_mix_by_line": _mart(marts.passenger_mix_by_line),
    "passenger_mix_network": _mart(marts.passenger_mix_network),
    "od_matrix": _mart(marts.od_matrix, _area_star, min_journeys=OD_MIN_JOURNEYS),
    "station_performance": _mart(marts.station_performance),
    "station_ranking": _mart(marts.station_ranking),
    "station_extremes": _mart(marts.station_extremes),
    "daily_vs_target": _mart(marts.daily_vs_target, target=DAILY_TARGET),
    "hourly_profile": _mart(marts.hourly_profile, st.event_star),
    "revenue_by_txn_type": _mart(marts.revenue_by, st.fare_star, "txn_type"),
    "revenue_by_fare_type": _mart(marts.revenue_by, st.fare_star, "fare_type"),
    "revenue_by_month": _mart(marts.revenue_by_month),
    "revenue_date_rollup": _mart(marts.revenue_date_rollup),
    # measures
    "measure_basic": _measures(report.KPI_MEASURES),
    "measure_basic_by_line": _measures(report.KPI_MEASURES, ["line_name"]),
    "daily_avg_revenue": _measures(["daily_avg_revenue"], ["line_name"]),
    "daily_target_scaled": _measures(["daily_avg_revenue", "daily_revenue_target"], ["year"]),
    "daily_avg_fixed_calendar": _short_calendar(["daily_avg_revenue"], ["line_name"]),
    "revenue_by_date_outside_calendar": _short_calendar(["total_revenue", "revenue_30d_rolling_avg"], ["date"]),
    "revenue_30d_calendar": _measures(["revenue_30d_rolling_avg"], ["date"]),
    "revenue_30d_by_station_month": _measures(
        ["total_revenue", "revenue_30d_rolling_avg"], ["station_name", "year", "month_no"]
    ),
    "revenue_share_context": _measures(
        ["total_revenue", "revenue_share"], ["line_name", "ticket_type"], {"line_name": LINE_SLICE}
    ),
    "digital_adoption": _measures(["digital_adoption"], ["line_name"], {"ticket_type": TYPE_SLICE}),
    "digital_adoption_by_type": _measures(["total_footfall", "digital_adoption"], ["ticket_type"]),
    "revenue_by_destination": _measures(["total_revenue", "revenue_by_destination"], ["station_name"]),
    "revenue_by_destination_sliced": _measures(
        ["total_revenue", "revenue_by_destination"], ["ticket_type"], {"line_name": LINE_SLICE}
    ),
    "revenue_by_line_left": _measures(["total_footfall", "revenue_by_destination"], ["line_name"]),
    # report datasets and slicers
    "trend_dataset": _report(report.trend, RATIO_DIGITS, filters={"date": DATE_SLICE}),
    "revenue_by_line": _report(report.revenue_by_line),
    "top_stations": _report(report.top_stations),
    "station_flow_matrix": _mart(report.station_flows),
    "station_flow_both_axes": _mart(report.station_flows, both_axes=True),
    "station_flow_wide": flow_matrix_wide,
    "passenger_mix_report": _report(report.passenger_mix),
    "station_flow_totals": _mart(report.station_flow_totals),
    "slice_line": _measures(report.KPI_MEASURES, ["ticket_type"], {"line_name": LINE_SLICE}),
    "slice_ticket_type": _measures(report.KPI_MEASURES, ["line_name"], {"ticket_type": TYPE_SLICE}),
    "slice_date_range": _measures(report.KPI_MEASURES, ["line_name"], {"date": DATE_SLICE}),
    "slice_station": _measures(report.KPI_MEASURES, ["ticket_type"], {"station_name": STATION_SLICE}),
    "station_flow_filtered": _report(report.selected_flows, filters=SELECTION),
    "dashboard_selected": _report(report.all_datasets, {"value": 2}, filters=SELECTION),
    "dashboard_cleared": _report(report.all_datasets, {"value": 2}),
    "dashboard_filtered": _report(
        report.dashboard, filters={"line_name": LINE_SLICE, "ticket_type": TYPE_SLICE}, known=FARE_MEASURES
    ),
    "dashboard_stored": dashboard_stored,
    "slice_calendar": slice_calendar,
    "slice_station_clustered": slice_station_clustered,
    "measure_totals": measure_totals,
    # sampling and quality
    "stratified_sample": stratified,
    "sample_exact": sample_exact,
    "sample_error": sample_error,
    "sample_estimate": sample_estimate,
    "sample_coded_ids": sample_coded_ids,
    "sample_validation": sample_validation,
    "sample_validation_worst": sample_validation_worst,
    "avg_ticket_vs_target": _mart(quality.average_ticket_against_target, target=AVG_TICKET_TARGET),
    "share_vs_target": share_vs_target,
    "distribution_profile": _mart(quality.profile),
    "days_covered": _mart(quality.days_covered),
    "reconcile_totals": _mart(quality.reconcile_totals),
    "blank_members": _mart(quality.blank_members),
}
