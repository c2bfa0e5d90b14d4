"""Stored sums: views equal a full recomputation, the fact isn't read, sketches merge in any order."""

import random
import re
from dataclasses import replace

import pytest
from fixtures import raw, values
from pyspark.sql import functions as F

from farelens.plans import load, marts, report, rollups
from farelens.plans.measures import evaluate
from farelens.sources import tables
from farelens.workload import standins as st
from farelens.workload.queries import SELECTION


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def trips(spark, ids, **change):
    """Raw rows with the given ids, over two months, three stations and two lines."""
    rng = random.Random(str(change))
    rows = [
        {
            "Sta": str(10 + i % 3),
            "Dest": str(10 + (i * 7) % 3),
            "Line": ["Red", "Blue"][i % 2],
            "PrType": ["NCMC", "Other"][i % 4 == 0],
            "Value": f"{rng.randint(1, 60)}.50",
            "InsertionDateTime": f"2024-0{5 + i % 2}-{1 + i % 28:02d} 08:00:00",
            **change,
        }
        for i in ids
    ]
    numbered = raw(spark, *rows)
    names = {position: i for position, i in enumerate(ids)}
    mapping = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    return numbered.withColumn("trx_id", mapping[F.col("trx_id").cast("int")].cast("bigint"))


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """After appends, a replay and a replaced month."""
    folder = str(tmp_path_factory.mktemp("star"))
    load.load_star(trips(spark, range(0, 60)), folder)
    load.load_star(trips(spark, range(30, 120)), folder)
    load.load_star(trips(spark, range(0, 60)), folder)
    return load.load_star(trips(spark, range(1, 40, 2), Value="2.00"), folder, replace_months=True)


VIEWS = {
    "trend": marts.daily_revenue_trend,
    "lines": marts.line_revenue_share,
    "stations": marts.station_performance,
    "contribution": marts.line_contribution,
    "mix": marts.passenger_mix_by_line,
    "ranking": marts.station_ranking,
    "extremes": marts.station_extremes,
    "target": lambda s: marts.daily_vs_target(s, 100),
    "rolling": marts.daily_revenue_rolling,
    "headline": marts.headline_kpis,
    "months": marts.revenue_by_month,
}


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_views_equal_a_full_recomputation_without_reading_the_fact(star, name):
    served, recomputed = VIEWS[name](star), VIEWS[name](replace(star, rollups=()))
    assert sorted(map(str, values(served))) == sorted(map(str, values(recomputed)))
    assert served.schema.simpleString() == recomputed.schema.simpleString()
    assert not any("/fact/" in path for path in served.inputFiles())
    assert any("/fact/" in path for path in recomputed.inputFiles()) or name == "ranking"


def test_replaced_months_retire_their_sums(star):
    june = marts.daily_totals(star).where("month(txn_date) = 6").agg(F.sum("footfall"), F.sum("revenue"))
    assert values(june) == [(20, 40.0)]


def test_loads_without_sums_fall_back_to_the_fact(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rollups, "write_rollups", lambda *_: None)
    first = load.load_star(trips(spark, range(10)), str(tmp_path))
    assert first.rollups == ()
    monkeypatch.undo()
    second = load.load_star(trips(spark, range(10, 20)), str(tmp_path))
    assert second.rollups == () and marts.daily_totals(second).agg(F.sum("footfall")).first()[0] == 20


def test_smallest_rollup_that_serves_is_chosen(star):
    sizes = {rollup.row_count for rollup in star.rollups}
    assert rollups.smallest(star.rollups, ["txn_date"]).row_count == min(sizes)
    assert "origin_station_id" in rollups.smallest(star.rollups, ["line_id", "origin_station_id"]).keys
    assert rollups.smallest(star.rollups, ["txn_type"]) is None


FILTERS = [
    None,
    {"ticket_type": ["NCMC"]},
    {"date": ("2024-05-03", "2024-06-10"), "ticket_type": ["NCMC", "Other"]},
    {"line_name": ["Red"], "station_name": ["Station 10", "Station 12"]},
    {"month_name": ["Jun"], "year": [2024]},
    {"date": ["2024-05-03", None]},
]


@pytest.mark.parametrize("filters", FILTERS, ids=str)
def test_dashboard_from_stored_sums(spark, star, filters):
    model = report.report_model(star)
    served, recomputed = report.all_datasets(model, filters), report.all_datasets(replace(model, rollups=()), filters)
    assert sorted(map(str, values(served))) == sorted(map(str, values(recomputed)))
    assert not any("/fact/" in path for path in served.inputFiles())


def test_dashboard_scans_the_fact_once(spark, sf_dir):
    model = st.fare_model(spark, sf_dir)
    made = plan(report.shared_sums(model, *report._needs(SELECTION, 29)))
    assert len(re.findall(r"FileScan parquet \[[^\]]*\].*lineitem", made)) == 1
    assert "GreaterThanOrEqual(l_shipdate" in made or "l_shipdate" in made
    assert "lineitem" not in plan(report.all_datasets(model, SELECTION))


def test_sketches_merge_in_any_order_within_their_error(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 20_000).cast("int").alias("origin_station_id"), (F.col("id") % 97).alias("part")
    )
    parts = rows.groupBy("part").agg(rollups.station_sketch().alias(rollups.SKETCH))
    estimates = set()
    for layout in (parts.repartition(1), parts.repartition(7, "part"), parts.orderBy(F.col("part").desc()), parts.unionByName(parts)):
        halves = layout.groupBy(F.col("part") % 5).agg(F.hll_union_agg(rollups.SKETCH).alias(rollups.SKETCH))
        estimates |= {r[0] for r in (layout.agg(rollups.estimated_stations(layout)).first(), halves.agg(rollups.estimated_stations(halves)).first())}
    assert len(estimates) == 1
    assert abs(estimates.pop() - 20_000) <= 4 * 0.0163 * 20_000


def test_approximate_stations_are_opt_in_and_read_the_smallest_sums(star):
    exact = values(marts.stations_covered(star, ["line_id"]).orderBy("line_id"))
    sketched = marts.stations_covered(star, ["line_id"], approximate=True)
    assert values(sketched.orderBy("line_id")) == exact  # few values are counted exactly
    assert all("/line_days/" in path for path in sketched.inputFiles())
    one_day = marts.stations_covered(star, first="2024-05-03", last="2024-05-03", approximate=True)
    assert values(one_day) == values(marts.stations_covered(star, first="2024-05-03", last="2024-05-03"))
    assert values(marts.headline_kpis(star, approximate=True)) == values(marts.headline_kpis(star))
    assert values(marts.headline_kpis(replace(star, rollups=()), approximate=True)) == values(marts.headline_kpis(star))


def test_empty_star(spark, tmp_path):
    empty = load.load_star(trips(spark, range(2)).limit(0), str(tmp_path))
    assert marts.daily_totals(empty).count() == 0 and values(marts.headline_kpis(empty, approximate=True))[0][3] == 0
    assert marts.station_extremes(empty).count() == 0


def test_calendar_attributes_skip_month_folders(spark, star):
    model = replace(report.report_model(star), rollups=())
    text = plan(evaluate(model, ["total_revenue"], ["line_name"], {"month_name": ["May"], "year": [2024]}))
    scans = re.findall(r"PartitionFilters: \[([^\n]*?)\], PushedFilters", text)
    assert any("txn_month" in scan and "dynamicpruning" in scan for scan in scans), scans


def test_a_station_filter_reads_few_row_groups(spark, tmp_path, sf_dir_larger):
    import glob

    import pyarrow.parquet as pq

    folder = str(tmp_path)
    load.load_star(
        st.raw_landing(spark, sf_dir_larger).unionByName(st.raw_landing(spark, sf_dir_larger).withColumn("trx_id", F.expr("trx_id + 100000"))),
        folder, st.EVENT_DIGITAL, cluster=True, row_group_bytes=4096,
    )
    groups = []
    for path in glob.glob(f"{folder}/fact/load_seq=1/status=accepted/*/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        names = [meta.schema.column(i).path for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            groups.append([meta.row_group(g).column(names.index(c)).statistics for c in ("origin_station_id", "dest_station_id")])
    assert len(groups) >= 60
    for side in (0, 1):
        for station in (7, 60, 100):
            held = [g for g in groups if g[side] is not None and g[side].has_min_max and g[side].min <= station <= g[side].max]
            assert len(held) / len(groups) < 0.2, (side, station, len(held), len(groups))
    assert tables.read_star(spark, folder).fact.count() > 15_000


def test_the_sort_along_the_curve_compares_columns_only(spark, sf_dir):
    rows = st.event_fact(spark, sf_dir).withColumn(tables.MONTH, tables.month_of(F.col("txn_date")))
    placed = tables.along_curve(rows, [tables.MONTH], [5, 9, 40])
    assert placed.columns == rows.columns
    orders = re.findall(r"\bSort \[(.*)\], (?:true|false)", plan(placed))
    assert orders and not any("(" in order for order in orders), orders


def test_station_steps_count_the_bounds_reached(spark):
    stations = spark.createDataFrame([(n,) for n in (None, -1, 0, 4, 5, 6, 9, 39, 40, 41)], "station int")
    for bounds in ([], [5], [0, 5, 9, 40], list(range(0, 63))):
        steps = values(stations.select("station", tables.station_step("station", bounds)))
        assert steps == [(n, 0 if n is None else sum(bound <= n for bound in bounds)) for n, _ in steps]


def test_raw_rows_of_one_row_group_are_dealt_over_tasks(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    count = 1000
    ids = [None if n % 97 == 0 else n // 2 for n in range(count)]  # some blank, the others on two rows
    events = {
        "event_id": pa.array(ids, pa.int64()),
        "ts": pa.array([1_704_067_200_000_000 + n * 60_000_000 for n in range(count)], pa.timestamp("us")),
        "user_id": pa.array([n % 150 for n in range(count)], pa.int64()),
        "event_type": ["view"] * count,
        "value": [1.5] * count,
        "props": ["{}"] * count,
    }
    pq.write_table(pa.table(events), f"{tmp_path}/events.parquet")
    whole = st.raw_landing(spark, str(tmp_path))  # few rows stay where they are
    assert all("/events.parquet" in path for path in whole.inputFiles())
    monkeypatch.setattr(st, "EVEN_ROWS", 100)
    monkeypatch.setattr(st, "_EVEN", {})
    dealt = st.raw_landing(spark, str(tmp_path))
    assert dealt.count() == count and dealt.exceptAll(whole).isEmpty() and whole.exceptAll(dealt).isEmpty()
    shares = values(dealt.groupBy(F.spark_partition_id()).count(), "count")
    assert max(share for (share,) in shares) <= count // 2
