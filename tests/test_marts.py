import datetime as dt
import random

import pytest
from fixtures import LINES, star, trip, values

from farelens.operators.ranking import count_positions, top_with_ties
from farelens.plans import marts, quality, report


def test_empty_fact(spark):
    empty = star(spark, [])
    assert values(marts.headline_kpis(empty))[0][:2] == (0, None)
    for build in (
        marts.daily_revenue_trend,
        marts.daily_revenue_rolling,
        marts.line_contribution,
        marts.passenger_mix_by_line,
        marts.od_matrix,
        marts.station_ranking,
        marts.station_extremes,
        marts.hourly_profile,
    ):
        assert build(empty).collect() == []
    assert values(marts.daily_vs_target(empty))[0][-1] == 0


def test_one_day_is_below_its_own_trend(spark):
    one = star(spark, [trip("2024-05-01", 10, 11, 1, 1, "5.00")])
    assert values(marts.daily_revenue_rolling(one)) == [(dt.date(2024, 5, 1), 5.0, 5.0, "below_trend")]
    assert values(marts.daily_revenue_trend(one), "revenue_dod_pct_change") == [(None,)]


def test_change_after_a_free_day_is_blank(spark):
    days = [("2024-05-01", "0.00"), ("2024-05-02", "5.00"), ("2024-05-03", "2.50")]
    rows = star(spark, [trip(day, 10, 11, 1, 1, fare) for day, fare in days])
    trend = marts.daily_revenue_trend(rows).orderBy("txn_date")
    assert values(trend, "revenue_dod_pct_change") == [(None,), (None,), (-50.0,)]


def test_rolling_average_counts_rows_not_days(spark):
    rows = star(
        spark, [trip("2024-01-01", 10, 11, 1, 1, "10.00"), trip("2024-03-01", 10, 11, 1, 1, "20.00")]
    )
    assert [v for (v,) in values(marts.daily_revenue_rolling(rows), "revenue_30d_rolling_avg")] == [10.0, 15.0]


def test_tied_lines_share_a_rank(spark):
    rows = star(spark, [trip("2024-05-01", 10, 11, line, 1, "5.00") for line in (1, 2)])
    assert values(marts.line_contribution(rows), "revenue_share_pct", "revenue_rank") == [(50.0, 1), (50.0, 1)]


def test_shares_add_up(spark):
    rows = star(
        spark,
        [trip("2024-05-01", 10, 11, 1 + n % 2, 1 + n % 3, f"{n}.37", hour=n % 24) for n in range(1, 60)],
    )
    for df, column in [
        (marts.line_revenue_share(rows), "revenue_share_pct"),
        (marts.hourly_profile(rows), "pct_of_daily_footfall"),
        (marts.passenger_mix_network(rows), "pct_of_network"),
    ]:
        assert abs(sum(v for (v,) in values(df, column)) - 100) < 0.2


def test_stations_that_share_a_name_merge_in_the_matrix(spark):
    rows = star(spark, [trip("2024-05-01", o, 11, 1, 1, "2.00") for o in (10, 13) for _ in range(60)])
    assert values(marts.od_matrix(rows)) == [("North", "South", "Red", 120, 240.0, 2.0)]


def test_matrix_threshold_is_strict_and_blank_destinations_drop(spark):
    rows = star(spark, [trip("2024-05-01", 10, 11, 1, 1, "2.00")] * 100 + [trip("2024-05-01", 10, None, 1, 1, "2.00")] * 200)
    assert marts.od_matrix(rows).collect() == []
    assert marts.od_matrix(rows, min_journeys=99).count() == 1


def test_matrix_cap_breaks_ties_by_name(spark):
    trips = [trip("2024-05-01", o, d, 1, 1, "2.00") for o, d in [(12, 11), (10, 11), (11, 10)]]
    top = marts.od_matrix(star(spark, trips), min_journeys=0, top=2)
    assert values(top, "origin_station", "destination_station") == [("East", "South"), ("North", "South")]


def test_one_station_on_two_lines_gives_two_rows(spark):
    rows = star(spark, [trip("2024-05-01", 10, 11, line, 1, "2.00") for line in (1, 2, 2)])
    assert sorted(values(marts.station_performance(rows), "station_id", "line_name", "footfall")) == [
        (10, "Blue", 2),
        (10, "Red", 1),
    ]


def test_daily_target(spark):
    rows = star(spark, [trip("2024-05-01", 10, 11, 1, 1, "10.00"), trip("2024-05-02", 10, 11, 1, 1, "5.00")])
    assert values(marts.daily_vs_target(rows, 10)) == [(7.5, 10, -25.0, 1, 2)]


def test_positions_match_a_plain_sort(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(-200_000, 400_000), rng.choice("ab"), rng.randrange(1, 6), 1) for _ in range(400)]
    rows = list({(i, label): (i, label, n, t) for i, label, n, t in rows}.values())
    df = spark.createDataFrame(rows, "id int, label string, n long, amount long")
    placed = values(
        count_positions(df, "n", "amount", "id", "label"), "id", "label", "from_largest", "from_smallest", "grand_total"
    )
    down = {r[:2]: k for k, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[0], r[1])), 1)}
    up = {r[:2]: k for k, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0], r[1])), 1)}
    assert sorted(placed) == sorted((i, s, down[i, s], up[i, s], len(rows)) for i, s, *_ in rows)


@pytest.mark.parametrize("n, expected", [(1, 2), (2, 2), (3, 3), (4, 5), (99, 5)])
def test_top_keeps_ties(spark, n, expected):
    df = spark.createDataFrame([("a", 9), ("b", 9), ("c", 5), ("d", 1), ("e", 1)], "name string, v int")
    assert top_with_ties(df, "v", n).count() == expected


def test_extremes_agree_with_the_ranking(spark):
    rows = star(spark, [trip("2024-05-01", o, 11, 1, 1, "2.00") for o in (10, 10, 11, 12, 12, 13)])
    ranked = marts.station_ranking(rows).where("busiest_rank = 1 OR quietest_rank = 1")
    assert sorted(values(ranked, "station_id")) == sorted(values(marts.station_extremes(rows), "station_id")) == [(10,), (11,)]


def test_rollup_levels(spark):
    rows = star(spark, [trip("2024-05-01", 10, 11, 1, 1, "2.00"), trip("2023-01-01", 10, 11, 1, 1, "3.00")])
    depths = [d for (d,) in values(marts.revenue_date_rollup(rows), "depth")]
    assert sorted(depths) == [0, 1, 1, 2, 2, 3, 3, 4, 4]


def test_serving_views(spark):
    marts.register_views(star(spark, [trip("2024-05-01", 10, 11, 1, 1, "2.00")]))
    for name in marts.SERVING_VIEWS:
        assert spark.sql(f"SELECT * FROM {name}").count() == 1


def test_integrity_finds_each_kind_of_violation(spark):
    broken = star(
        spark,
        [
            trip("2024-05-01", 10, 11, 1, 1, "-2.00"),
            trip("2024-05-01", 99, 98, 9, 9, None),
            trip("2024-05-01", 10, None, 1, 1, "2.00"),
        ],
        lines=[*LINES, (3, "Red", "x", True)],
    )
    found = dict(values(quality.integrity_report(broken)))
    assert {name: n for name, n in found.items() if n} == {
        "fare_not_negative": 1,
        "not_null:fare_amount": 1,
        "unique:line_name": 1,
        "fk:origin_station_id": 1,
        "fk:dest_station_id": 1,
        "fk:line_id": 1,
        "fk:passenger_type_id": 1,
    }


def test_blank_members_and_reconciliation(spark):
    rows = star(spark, [trip("2024-05-01", 99, None, 1, 1, "2.00"), trip("2024-05-01", 10, 11, 1, 1, "3.01")])
    assert sorted(values(quality.blank_members(rows))) == [
        ("destination_station", 1, 2),
        ("line", 0, 2),
        ("origin_station", 1, 2),
        ("passenger_type", 0, 2),
    ]
    assert values(quality.reconcile_totals(rows)) == [(2, 5.01, 2.51, 5.02, 0.1996, True)]


def test_wide_flow_matrix(spark):
    rows = star(spark, [trip("2024-05-01", 10, 11, 1, 1, "2.00"), trip("2024-05-01", 12, 11, 1, 1, "3.00")])
    wide = report.flow_matrix_wide(rows, ["South", "East"])
    assert sorted(values(wide, "origin", "South", "East")) == [("East", 3.0, None), ("North", 2.0, None)]


def test_flows_keep_the_blank_destination(spark):
    rows = star(spark, [trip("2024-05-01", 10, None, 1, 1, "9.00"), trip("2024-05-01", 10, 11, 1, 1, "2.00")])
    assert values(report.station_flows(rows, top=1)) == [("North", None, 9.0)]


def test_worst_difference(spark):
    fact = star(spark, [trip("2024-05-01", 10, 11, 1 + n % 2, 1, "1.00", hour=n % 3) for n in range(30)]).fact
    same = quality.worst_difference(quality.sample_validation(fact, fact))
    assert sorted(values(same)) == [("hour", 3, 0.0), ("line", 2, 0.0)]
    part = quality.sample_validation(fact, fact.where("line_id = 1"))
    assert dict(values(part.where("profile = 'line'"), "member", "sample_pct")) == {"1": 100.0, "2": 0.0}
