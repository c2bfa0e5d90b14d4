"""The plans have the shape they should have on a cluster."""

import re

import pytest

from farelens.plans import marts, report
from farelens.plans.measures import evaluate
from farelens.workload import standins as st


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def fact_scans(text: str, table: str = "lineitem") -> list[str]:
    return re.findall(rf"FileScan parquet \[([^\]]*)\].*{table}", text)


LAZY = {
    "headline": lambda s: marts.headline_kpis(s),
    "trend": lambda s: marts.daily_revenue_trend(s),
    "lines": lambda s: marts.line_contribution(s),
    "od": lambda s: marts.od_matrix(s),
    "stations": lambda s: marts.station_performance(s),
    "target": lambda s: marts.daily_vs_target(s),
    "rollup": lambda s: marts.revenue_date_rollup(s),
}


@pytest.mark.parametrize("name", sorted(LAZY))
def test_one_pruned_scan_and_partial_aggregation(spark, sf_dir, name):
    text = plan(LAZY[name](st.fare_star(spark, sf_dir)))
    scans = fact_scans(text)
    assert len(scans) == 1 and len(scans[0].split(",")) <= 6
    assert "partial_" in text
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "Python", "Pandas"):
        assert bad not in text


def test_joins_sit_above_the_aggregation(spark, sf_dir):
    text = plan(marts.od_matrix(st.fare_star(spark, sf_dir)))
    lines = text.splitlines()
    first_partial = max(i for i, line in enumerate(lines) if "partial_sum(" in line and "fare_amount" in line)
    scan = max(i for i, line in enumerate(lines) if "lineitem" in line)
    between = [line for line in lines[first_partial:scan] if "Join" in line]
    assert between == []


def test_dimensions_are_broadcast_by_measured_size_only(spark, sf_dir):
    frame = marts.line_contribution(st.fare_star(spark, sf_dir))
    assert "BroadcastHashJoin" in plan(frame)
    logical = frame._jdf.queryExecution().logical().toString()
    assert "UnresolvedHint" not in logical and "broadcast" not in logical.lower()


def test_date_slicer_reaches_the_scan(spark, sf_dir):
    rows = evaluate(st.fare_model(spark, sf_dir), ["total_revenue"], ["line_name"], {"date": ("1997-01-01", "1997-12-31")})
    pushed = re.search(r"lineitem[^\n]*PushedFilters: \[([^\]]*)\]", plan(rows)).group(1)
    assert "GreaterThanOrEqual(l_shipdate" in pushed and "LessThan(l_shipdate" in pushed


def test_ticket_slicer_reaches_the_scan_unless_a_measure_replaces_it(spark, sf_dir):
    model = st.fare_model(spark, sf_dir)
    plain = plan(evaluate(model, ["total_revenue"], ["line_name"], {"ticket_type": ["A"]}))
    assert "In(l_returnflag, [A])" in plain or "EqualTo(l_returnflag,A)" in plain
    replaced = plan(evaluate(model, ["total_revenue", "digital_adoption"], ["line_name"], {"ticket_type": ["A"]}))
    assert "EqualTo(l_returnflag,A)" not in replaced


def test_measures_of_one_role_share_a_scan(spark, sf_dir):
    names = ["total_footfall", "total_revenue", "avg_ticket_value", "revenue_share", "digital_adoption"]
    frame = evaluate(st.fare_model(spark, sf_dir), names, ["line_name"], {"line_name": ["ASIA"]})
    assert len(fact_scans(plan(frame))) == 1


def test_single_task_windows_only_follow_an_aggregate(spark, sf_dir):
    for build in (marts.daily_revenue_trend, marts.line_contribution):
        text = plan(build(st.fare_star(spark, sf_dir)))
        assert text.index("Window") < text.index("SinglePartition") < text.index("HashAggregate")


def test_top_list_is_a_top_k_not_a_sort(spark, sf_dir):
    text = plan(report.top_stations(st.fare_model(spark, sf_dir)))
    assert "TakeOrderedAndProject" in text and "Window" not in text
