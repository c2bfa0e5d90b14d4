"""Trailing calendar windows from running totals, against plain Python."""

import datetime as dt
import random

import pytest

from farelens.operators.trends import trailing_day_totals

START = dt.date(2024, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


def brute(rows, anchors, days):
    out = set()
    for key in {k for k, _, _ in rows}:
        for name, anchor in anchors:
            inside = [(d, v) for k, d, v in rows if k == key and anchor - days < d <= anchor]
            if inside:
                known = [v for _, v in inside if v is not None]
                out.add((key, name, sum(known) if known else 0, len(known)))
    return out


@pytest.mark.parametrize("days", [1, 3, 30])
@pytest.mark.parametrize("density", [0.05, 0.4, 1.0])
def test_equals_plain_windows(spark, days, density):
    rng = random.Random(days * 100 + int(density * 10))
    rows = [
        (key, n, None if rng.random() < 0.1 else rng.randint(1, 99))
        for key in ("a", "b", None)
        for n in range(120)
        if rng.random() < density
    ]
    anchors = [(f"x{n}", n) for n in sorted(rng.sample(range(150), 60))]
    daily = spark.createDataFrame([(k, day(n), v) for k, n, v in rows], "k string, d date, v int").selectExpr("k", "d", "cast(v AS decimal(20,2)) AS v")
    ends = spark.createDataFrame([(name, day(n)) for name, n in anchors], "g string, anchor date")
    found = trailing_day_totals(daily, ends, ["k"], ["g"], "d", "v", days).collect()
    assert {(r["k"], r["g"], int(r["window_total"] or 0), r["window_days"]) for r in found} == brute(rows, anchors, days)
    assert len(found) == len(brute(rows, anchors, days))


def test_without_groups_or_keys(spark):
    daily = spark.createDataFrame([(day(0), 5), (day(9), 7)], "d date, v int").selectExpr("d", "cast(v AS decimal(20,2)) AS v")
    end = spark.createDataFrame([(day(9),)], "anchor date")
    (row,) = trailing_day_totals(daily, end, [], [], "d", "v", 10).collect()
    assert (int(row["window_total"]), row["window_days"]) == (12, 2)
    assert trailing_day_totals(daily.limit(0), end, [], [], "d", "v", 10).count() == 0
    assert trailing_day_totals(daily, end.where("false"), [], [], "d", "v", 10).count() == 0


def test_rows_grow_with_days_not_with_the_window(spark):
    """Each day with a value stands for the days up to the next: on dense days one row each, whatever the window."""
    daily = spark.range(400).selectExpr("date_add(DATE'2024-01-01', cast(id AS int)) AS d", "cast(1 AS decimal(20,2)) AS v")
    anchors = daily.selectExpr("d AS anchor")
    text = trailing_day_totals(daily, anchors, [], [], "d", "v", 30)._jdf.queryExecution().optimizedPlan().toString()
    assert "least(date_sub(" in text  # the reach ends before the next day
    found = trailing_day_totals(daily, anchors, [], [], "d", "v", 30)
    assert found.count() == 400
