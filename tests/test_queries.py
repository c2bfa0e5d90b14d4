"""Every registered query against its SQL."""

import oracle
import pytest

import __spark_entry__ as entry_module
from farelens.workload.oracles import ORACLES
from farelens.workload.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sf_dir, duck, name):
    assert oracle.compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


MORE_ROWS = [
    "od_matrix", "station_ranking", "revenue_30d_by_station_month", "load_fact", "serving_views_maintained", "dashboard_stored",
    "measure_totals", "sample_exact", "sample_estimate", "load_duplicates",
]


@pytest.mark.parametrize("name", MORE_ROWS)
def test_matches_sql_on_more_rows(spark, sf_dir_larger, name):
    assert oracle.compare(QUERIES[name](spark, sf_dir_larger), oracle.connect(sf_dir_larger), ORACLES[name]) is None


SHUFFLED = [
    "line_contribution",
    "passenger_mix_by_line",
    "od_matrix",
    "station_ranking",
    "top_stations",
    "station_flow_both_axes",
    "revenue_by_destination",
    "revenue_share_context",
    "revenue_30d_by_station_month",
    "load_fact",
    "load_rejects",
    "flat_extract",
    "integrity_report",
]


@pytest.mark.parametrize("name", SHUFFLED)
def test_same_result_when_nothing_may_be_broadcast(spark, sf_dir, duck, name):
    """Dimensions that outgrow a broadcast take the shuffle join, with the same result."""
    before = {key: spark.conf.get(key) for key in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = QUERIES[name](spark, sf_dir)
        assert oracle.compare(frame, duck, ORACLES[name]) is None
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 5
