"""Measures against a plain-Python evaluation of the same rules."""

import datetime as dt
import random

import pytest
from fixtures import LINES, STATIONS, TYPES, model, star, trip, values
from pyspark.sql import functions as F

from farelens.plans import marts, report
from farelens.plans.measures import ReportModel, catalogue, evaluate

STATION = {s[0]: s for s in STATIONS}
LINE_NAME = {line[0]: line[1] for line in LINES}
TYPE_NAME = {t[0]: t[1] for t in TYPES}
START = dt.date(2024, 1, 1)


def random_trips(count=300, seed=3):
    rng = random.Random(seed)
    return [
        trip(
            (START + dt.timedelta(days=rng.choice([0, 1, 5, 20, 34, 35, 60, 80]))).isoformat(),
            rng.choice([10, 11, 12, 13, 99]),
            rng.choice([10, 11, 12, 13, None]),
            rng.choice([1, 2]),
            rng.choice([1, 2, 3]),
            f"{rng.randrange(1, 6000) / 100:.2f}",
        )
        for _ in range(count)
    ]


def member(row, field, role="origin"):
    station = STATION.get(row[3] if role == "origin" else row[4])
    return {
        "date": row[2],
        "month_no": row[2].month,
        "year": row[2].year,
        "line_name": LINE_NAME[station[2]] if station else None,
        "station_name": station[1] if station else None,
        "ticket_type": TYPE_NAME[row[6]],
    }[field]


def selected(row, filters, role="origin"):
    for field, choice in filters.items():
        value = member(row, field, role)
        if isinstance(choice, tuple):
            if not dt.date.fromisoformat(choice[0]) <= value <= dt.date.fromisoformat(choice[1]):
                return False
        elif value not in choice:
            return False
    return True


def total(rows):
    return sum(row[9] for row in rows)


def expected(trips, group_by, filters, role="origin"):
    groups = {}
    for row in trips:
        if selected(row, filters, role):
            groups.setdefault(tuple(member(row, f, role) for f in group_by), []).append(row)
    return groups


GROUPINGS = [[], ["line_name"], ["ticket_type"], ["line_name", "ticket_type"], ["station_name"], ["month_no", "line_name"]]
FILTERS = [
    {},
    {"line_name": ["Red"]},
    {"line_name": ["Red", None]},
    {"ticket_type": ["Other", "NCMC"]},
    {"date": ("2024-01-02", "2024-02-10")},
    {"station_name": ["North"], "ticket_type": ["QR Ticket"]},
]


@pytest.fixture(scope="module")
def trips():
    return random_trips()


@pytest.fixture(scope="module")
def report_model(spark, trips):
    built = model(spark, trips)
    return ReportModel(built.fact.cache(), built.stations, built.lines, built.calendar.cache())


def result(report_model, names, group_by, filters):
    rows = values(evaluate(report_model, names, group_by, filters))
    return {row[: len(group_by)]: row[len(group_by) :] for row in rows}


CASES = [(g, f) for g in GROUPINGS for f in FILTERS if g in (["line_name", "ticket_type"], ["month_no", "line_name"]) or len(f) < 2]


@pytest.mark.parametrize("group_by, filters", CASES[::2])
def test_context_measures(report_model, trips, group_by, filters):
    names = ["total_footfall", "total_revenue", "daily_avg_revenue", "stations_covered", "revenue_share", "digital_adoption"]
    found = result(report_model, names, group_by, filters)
    groups = expected(trips, group_by, filters)
    assert set(found) == set(groups)
    no_line = expected(trips, [f for f in group_by if f != "line_name"], {k: v for k, v in filters.items() if k != "line_name"})
    digital = expected(
        trips,
        [f for f in group_by if f != "ticket_type"],
        {**filters, "ticket_type": ["NCMC", "QR Ticket"]},
    )
    for key, rows in groups.items():
        named = dict(zip(group_by, key))
        whole = no_line[tuple(v for f, v in named.items() if f != "line_name")]
        part = digital.get(tuple(v for f, v in named.items() if f != "ticket_type"))
        footfall, revenue, daily, stations, share, adoption = found[key]
        assert footfall == len(rows)
        assert revenue == pytest.approx(float(total(rows)))
        assert daily == pytest.approx(float(total(rows)) / len({r[2] for r in rows}))
        assert stations == len({r[3] for r in rows})
        assert share == pytest.approx(float(total(rows) / total(whole)))
        assert adoption == (pytest.approx(len(part) / len(rows)) if part else None)


@pytest.mark.parametrize("group_by", [["station_name"], ["ticket_type"]])
@pytest.mark.parametrize("filters", [{}, {"line_name": ["Blue"]}])
def test_destination_role(report_model, trips, group_by, filters):
    found = result(report_model, ["revenue_by_destination"], group_by, filters)
    groups = expected(trips, group_by, filters, "destination")
    assert found == {k: (pytest.approx(float(total(rows))),) for k, rows in groups.items()}


@pytest.mark.parametrize("others", [[], ["line_name"]])
@pytest.mark.parametrize("dates", [["date"], ["month_no"], []])
@pytest.mark.parametrize("filters", [{}, {"date": ("2024-02-01", "2024-02-20")}, {"ticket_type": ["Other"]}])
def test_trailing_window(report_model, trips, others, dates, filters):
    group_by = [*dates, *others]
    found = result(report_model, ["revenue_30d_rolling_avg"], group_by, filters)
    rest = {k: v for k, v in filters.items() if k != "date"}
    first, last = min(r[2] for r in trips), max(r[2] for r in trips)
    calendar = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    if "date" in filters:
        low, high = map(dt.date.fromisoformat, filters["date"])
        calendar = [day for day in calendar if low <= day <= high]
    anchors = {}
    for day in calendar:
        key = {"date": (day,), "month_no": (day.month,)}[dates[0]] if dates else ()
        anchors[key] = max(day, anchors.get(key, day))
    wanted = {}
    for key, anchor in anchors.items():
        window = [r for r in trips if selected(r, rest) and 0 <= (anchor - r[2]).days <= 29]
        for other in {tuple(member(r, f) for f in others) for r in window}:
            rows = [r for r in window if tuple(member(r, f) for f in others) == other]
            wanted[key + other] = (pytest.approx(float(total(rows)) / len({r[2] for r in rows})),)
    assert found == wanted


def test_blank_on_nothing(spark):
    empty = model(spark, [])
    assert values(evaluate(empty, report.KPI_MEASURES)) == [(None, None, None, None)]
    assert evaluate(empty, report.KPI_MEASURES, ["line_name"]).collect() == []


def test_blank_station_code_counts_once(spark):
    trips = [trip("2024-05-01", o, 11, 1, 1, "1.00") for o in (10, 10, None, None)]
    assert values(evaluate(model(spark, trips), ["stations_covered"])) == [(2,)]


def test_unfiltered_share_agrees_with_the_mart_when_lines_agree(spark):
    trips = [trip("2024-05-01", o, 11, STATION[o][2], 1, f"{o}.00") for o in (10, 11, 12, 13)]
    shares = dict(values(evaluate(model(spark, trips), ["revenue_share"], ["line_name"])))
    mart = dict(values(marts.line_revenue_share(star(spark, trips)), "line_name", "revenue_share_pct"))
    assert {k: round(100 * v, 2) for k, v in shares.items()} == mart


def test_row_and_calendar_windows_agree_without_gaps(spark):
    trips = [trip((START + dt.timedelta(days=n)).isoformat(), 10, 11, 1, 1, f"{n}.25") for n in range(40)]
    by_rows = values(marts.daily_revenue_rolling(star(spark, trips)), "txn_date", "revenue_30d_rolling_avg")
    by_days = values(evaluate(model(spark, trips), ["revenue_30d_rolling_avg"], ["date"]))
    assert sorted(by_rows) == sorted(by_days)


def test_rollup_gives_the_same_answers(spark, report_model):
    names = ["total_footfall", "total_revenue", "revenue_share", "revenue_by_destination"]
    served = report.rollup_fact(report_model, ["line_name", "ticket_type"], ["origin", "destination"])
    for group_by in (["line_name"], ["ticket_type"]):
        assert result(served, names, group_by, {"line_name": ["Red"]}) == result(
            report_model, names, group_by, {"line_name": ["Red"]}
        )


def test_dashboard_under_a_cleared_selection(report_model, trips):
    rows = report.dashboard(report_model)
    assert values(rows.where("dataset = 'kpi'"), "total_footfall") == [(len(trips),)]
    per_dataset = dict(values(rows.groupBy("dataset").agg(F.sum("total_footfall"))))
    assert set(per_dataset.values()) == {len(trips)}


def test_every_dataset_answers_a_slicer(report_model):
    plain, sliced = (report.dashboard(report_model, f) for f in ({}, {"line_name": ["Red"]}))
    totals = [dict(values(df.groupBy("dataset").agg(F.sum("total_footfall")))) for df in (plain, sliced)]
    assert all(totals[1][name] < totals[0][name] for name in totals[0])


def test_passenger_mix_adds_up_per_line(report_model):
    mix = report.passenger_mix(report_model).groupBy("line_name").agg(F.sum("pct_within_line"))
    assert all(abs(v - 100) < 0.05 for _, v in values(mix))


def test_catalogue_is_complete():
    assert len(catalogue()) == 10


def test_kpi_and_line_datasets(report_model, trips):
    assert values(report.kpi_cards(report_model), "total_footfall") == [(len(trips),)]
    revenue = [v for _, v in values(report.revenue_by_line(report_model))]
    assert revenue == sorted(revenue, reverse=True)


def test_top_stations_ranks_after_the_filter(spark):
    trips = [trip("2024-05-01", 11, 10, 1, 1, "9.00"), trip("2024-05-01", 12, 10, 2, 3, "5.00")]
    top = report.top_stations(model(spark, trips), 1, {"ticket_type": ["Other"]})
    assert values(top) == [("East", 5.0)]


def test_totals_are_evaluated_at_each_level(report_model):
    """Every level equals an evaluation of its own; distinct stations and averages don't add up from cells."""
    names = list(catalogue())
    for filters in (None, {"date": ("2024-01-02", "2024-02-20")}, {"line_name": ["Red"], "ticket_type": ["NCMC"]}):
        rows = evaluate(report_model, names, ["line_name", "ticket_type"], filters, totals=True)
        for level, kept in enumerate([["line_name", "ticket_type"], ["line_name"], ["ticket_type"], []]):
            own = evaluate(report_model, names, kept, filters)
            found = rows.where(f"level = {level}")
            assert sorted(map(str, values(found, *kept, *names))) == sorted(map(str, values(own, *kept, *names)))
            assert found.where(" OR ".join(f"{n} IS NOT NULL" for n in ("line_name", "ticket_type") if n not in kept) or "false").count() == 0


def test_totals_over_dates(report_model):
    names = ["total_revenue", "stations_covered", "revenue_30d_rolling_avg"]
    rows = evaluate(report_model, names, ["year", "month_name"], None, totals=True)
    assert {row["level"] for row in rows.collect()} == {0, 1, 2, 3}
    assert values(rows.where("level = 3"), *names) == values(evaluate(report_model, names))
