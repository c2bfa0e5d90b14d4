import pytest
from fixtures import raw, values
from pyspark.sql import functions as F

from farelens.plans import load
from farelens.sources import tables
from farelens.sources.extracts import CORRUPT


def converted(spark, *changes):
    rows = raw(spark, *changes)
    lines = load.seed_lines(rows)
    types = load.seed_passenger_types(rows)
    return load.convert(rows, lines, types, load.seed_stations(rows, lines))


def reasons(spark, *changes):
    # The first row makes station 11 an origin, so that it is a valid destination.
    rows = converted(spark, {"Sta": "11"}, *changes).orderBy("transaction_id")
    return [reason for (reason,) in values(rows, "reject_reason")][1:]


@pytest.mark.parametrize(
    "change, reason",
    [
        ({}, None),
        ({"Value": "0"}, None),
        ({"Value": "N/A"}, "fare"),
        ({"Value": "-5.00"}, "fare"),
        ({"Value": ""}, "fare"),
        ({"Value": None}, "fare"),
        ({"Value": "1."}, "fare"),
        ({"Value": "12.50\n"}, "fare"),
        ({"Value": "123456789.00"}, "fare"),
        ({"Sta": "X7"}, "origin"),
        ({"Sta": "7\n"}, "origin"),
        ({"Sta": " 7"}, "origin"),
        ({"Sta": None}, "origin"),
        ({"Sta": "99999999999"}, "origin"),
        ({"Dest": ""}, None),
        ({"Dest": None}, None),
        ({"Dest": "ABC"}, "destination"),
        ({"Dest": "9999"}, "destination_fk"),
        ({"InsertionDateTime": "not-a-time"}, "timestamp"),
        ({"InsertionDateTime": "2024-02-30 10:00:00"}, "timestamp"),
        ({"InsertionDateTime": None}, "timestamp"),
        ({"Line": None}, "line"),
        ({"PrType": None}, "passenger_type"),
        ({"Value": "bad", "Sta": "bad", "Dest": "bad"}, "fare"),
        ({"Dest": "9999", "PrType": None}, "passenger_type"),
    ],
)
def test_reject_reason(spark, change, reason):
    assert reasons(spark, change) == [reason]


def test_fare_rounds_half_up(spark):
    rows = converted(spark, {"Sta": "11", "Value": "12.345"}, {"Sta": "11", "Value": "12.344"})
    assert sorted(values(rows, "fare_amount")) == [(12.34,), (12.35,)]


def test_no_row_is_lost(spark):
    rows = converted(spark, {"Sta": "11"}, {"Value": "x"}, {"Line": None}, {"Dest": ""})
    assert values(load.reconcile(rows)) == [(4, 2, 2, 25.0, True)]
    assert load.accepted(rows).count() + load.rejects(rows).count() == 4


def test_strict_fails_on_a_reject(spark):
    good = converted(spark, {"Sta": "11"})
    assert load.accepted(good, strict=True).count() == 1
    with pytest.raises(Exception, match="rejected row: fare"):
        load.accepted(converted(spark, {"Value": "x"}), strict=True).collect()


def test_smallest_colour_and_line_win(spark):
    rows = raw(
        spark,
        {"LineCC": "Z"},
        {"LineCC": "A"},
        {"Line": "Blue", "LineCC": None},
        {"Line": None},
    )
    lines = load.seed_lines(rows)
    assert sorted(values(lines)) == [(1, "Blue", None, True), (2, "Red", "A", True)]
    assert values(load.seed_stations(rows, lines)) == [(10, "Station 10", 1, False)]


def test_codes_that_differ_only_in_zeros_are_one_station(spark):
    rows = raw(spark, {"Sta": "7"}, {"Sta": "007"})
    assert values(load.seed_stations(rows, load.seed_lines(rows))) == [(7, "Station 007", 1, False)]


def test_new_lines_are_numbered_after_existing_ones(spark):
    existing = load.seed_lines(raw(spark, {}))
    rows = raw(spark, {}, {"Line": "Amber"}, {"Line": "Blue"})
    assert sorted(values(load.seed_lines(rows, existing), "line_id", "line_name")) == [(2, "Amber"), (3, "Blue")]


def test_passenger_types(spark):
    rows = raw(spark, {}, {"PrType": "Other"}, {"PrType": None})
    assert sorted(values(load.seed_passenger_types(rows))) == [(1, "NCMC", True), (2, "Other", False)]


def test_date_dimension_covers_gaps_and_skips_bad_times(spark):
    rows = raw(
        spark, {}, {"InsertionDateTime": "2024-05-04 00:00:00"}, {"InsertionDateTime": "nonsense"}
    )
    days = values(load.seed_dates(load.key_combinations(rows)).orderBy("date_key"))
    assert len(days) == 4
    assert days[-1][1:] == (2024, 2, 5, "May", 4, 6, "Sat", True)


def test_load_star_writes_and_reads_back(spark, tmp_path):
    rows = raw(
        spark,
        {"Sta": "11"},
        {"InsertionDateTime": "2024-06-01 00:00:00"},
        {"Value": "x"},
        {"InsertionDateTime": "x"},
    )
    star = load.load_star(rows, str(tmp_path))
    assert sorted(values(star.fact, "transaction_id", tables.MONTH)) == [(0, "2024-05"), (1, "2024-06")]
    assert star.stations.count() == 2 and star.dates.count() == 32
    left = values(load.open_rejects(spark, str(tmp_path)), "transaction_id", "reject_reason", "raw_text")
    assert sorted(row[:2] for row in left) == [(2, "fare"), (3, "timestamp")]
    assert all('"Sta":"10"' in row[2] for row in left)


def test_records_that_are_none(spark):
    rows = raw(spark, {"Sta": "11"}, {"Sta": "11"}, {"Sta": "11"}).withColumns(
        {
            "trx_id": F.when(F.col("trx_id") > 0, F.col("trx_id")),
            CORRUPT: F.when(F.col("trx_id") == 1, "1,too,few"),
        }
    )
    lines = load.seed_lines(rows)
    found = load.convert(rows, lines, load.seed_passenger_types(rows), load.seed_stations(rows, lines))
    assert sorted(values(load.rejects(found), "reject_reason")) == [("record",), ("transaction_id",)]
    assert "1,too,few" in [text for (text,) in values(load.rejects(found), "raw_text")]


def test_a_second_load_keeps_keys_and_rows(spark, tmp_path):
    first = raw(spark, {"Sta": "11"}, {"InsertionDateTime": "2024-05-02 08:00:00"})
    load.load_star(first, str(tmp_path))
    more = raw(spark, {"Line": "Amber", "Sta": "12", "InsertionDateTime": "2024-05-09 08:00:00"}, {"Sta": "11"})
    star = load.load_star(more.withColumn("trx_id", F.col("trx_id") + 10), str(tmp_path))
    assert sorted(values(star.lines, "line_id", "line_name")) == [(1, "Red"), (2, "Amber")]
    assert sorted(values(star.fact, "transaction_id", "line_id")) == [(0, 1), (1, 1), (10, 2), (11, 1)]
    assert star.stations.count() == 3 and star.dates.count() == 9
    again = load.load_star(first, str(tmp_path))
    assert again.fact.count() == 4


def test_replacing_months(spark, tmp_path):
    load.load_star(raw(spark, {"Sta": "11"}, {"Sta": "11"}, {"Sta": "11", "InsertionDateTime": "2024-06-01 00:00:00"}), str(tmp_path))
    star = load.load_star(raw(spark, {"Sta": "11", "Value": "1.00"}), str(tmp_path), replace_months=True)
    assert sorted(values(star.fact, tables.MONTH, "fare_amount")) == [("2024-05", 1.0), ("2024-06", 12.5)]


def test_rejects_last_until_dealt_with(spark, tmp_path):
    folder = str(tmp_path)
    load.load_star(raw(spark, {"Sta": "11"}, {"Value": "x", "Sta": "11"}, {"InsertionDateTime": "x"}), folder)
    load.load_star(raw(spark, {"Sta": "11"}).withColumn("trx_id", F.lit(50).cast("bigint")), folder)
    assert sorted(values(load.open_rejects(spark, folder), "transaction_id")) == [(1,), (2,)]
    mended = raw(spark, {"Sta": "11"}, {"Sta": "11"}, {"InsertionDateTime": "x"})
    star = load.load_star(mended, folder)
    assert values(load.open_rejects(spark, folder), "transaction_id", "load_seq") == [(2, 3)]
    assert star.fact.count() == 3


def test_a_failed_load_changes_nothing(spark, tmp_path):
    folder = str(tmp_path)
    load.load_star(raw(spark, {"Sta": "11"}), folder)
    with pytest.raises(Exception, match="rejected row"):
        load.load_star(raw(spark, {"Line": "Amber", "Value": "x"}), folder, strict=True)
    star = tables.read_star(spark, folder)
    assert values(star.lines, "line_name") == [("Red",)] and star.fact.count() == 1
    star = load.load_star(raw(spark, {"Sta": "11"}, {"Sta": "11", "Line": "Blue"}), folder)
    assert sorted(values(star.lines, "line_id", "line_name")) == [(1, "Red"), (2, "Blue")] and star.fact.count() == 2


def test_empty_raw(spark, tmp_path):
    star = load.load_star(raw(spark, {}).limit(0), str(tmp_path))
    assert star.lines.count() == star.dates.count() == 0


def test_replacing_a_month_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = converted(spark, {"Sta": "11"}, {"Sta": "11", "InsertionDateTime": "2024-06-01 00:00:00"})
    fact = load.accepted(rows)
    tables.write_fact(fact, path)
    tables.write_fact(fact.where("txn_date >= '2024-06-01'").selectExpr("* EXCEPT (fare_amount)", "cast(1 AS decimal(10,2)) AS fare_amount"), path)
    again = tables.read_fact(spark, path)
    assert sorted(values(again, tables.MONTH, "fare_amount")) == [("2024-05", 12.5), ("2024-06", 1.0)]


def test_an_extract_that_arrives_twice_in_one_load_counts_once(spark, tmp_path):
    rows = raw(spark, {"Sta": "11"}, {"InsertionDateTime": "2024-06-01 00:00:00"}, {"Value": "x"})
    once = load.load_star(rows, str(tmp_path / "once"))
    twice = load.load_star(rows.unionByName(rows), str(tmp_path / "twice"))
    assert sorted(map(str, values(twice.fact))) == sorted(map(str, values(once.fact)))
    left = values(load.open_rejects(spark, str(tmp_path / "twice")), "transaction_id", "reject_reason")
    assert sorted(left) == [(0, "duplicate_id"), (1, "duplicate_id"), (2, "fare"), (2, "fare")]
    again = load.load_star(rows.unionByName(rows), str(tmp_path / "twice"))
    assert again.fact.count() == 2


def test_the_first_record_of_an_id_is_accepted(spark, tmp_path):
    rows = raw(
        spark,
        {"Sta": "11", "Value": "3.00", "InsertionDateTime": "2024-05-03 00:00:00"},
        {"Sta": "11", "Value": "2.00", "InsertionDateTime": "2024-05-02 00:00:00"},
        {"Sta": "11", "Value": "x", "InsertionDateTime": "2024-05-01 00:00:00"},
        {"Sta": "11", "Value": "4.00", "InsertionDateTime": "2024-06-01 00:00:00"},
    ).withColumn("trx_id", F.lit(5).cast("bigint"))
    star = load.load_star(rows, str(tmp_path))
    assert values(star.fact, "transaction_id", "fare_amount") == [(5, 2.0)]
    left = values(load.open_rejects(spark, str(tmp_path)), "reject_reason", "fare_text")
    assert sorted(left) == [("duplicate_id", "3.00"), ("duplicate_id", "4.00")]  # id 5 itself was accepted


def test_a_hot_id(spark, tmp_path):
    rows = raw(spark, *[{"Sta": "11", "Value": f"{n % 7}.00"} for n in range(300)])
    rows = rows.withColumn("trx_id", F.when(F.col("trx_id") < 200, 1).otherwise(F.col("trx_id")))
    folder = str(tmp_path / "dimensions")
    load.write_dimensions(rows, folder, [])
    found = load.convert_once_each(rows, folder)
    assert values(load.reconcile(found))[0][:3] == (300, 101, 199)
    assert {reason for (reason,) in values(load.rejects(found), "reject_reason")} == {"duplicate_id"}
    assert all('"Sta":"11"' in text for (text,) in values(load.rejects(found), "raw_text"))
    kept = load.accepted(found).where("transaction_id = 1")
    assert values(kept, "fare_amount") == [(0.0,)]  # equal times: the smallest record


def test_without_repeated_ids_no_row_is_shuffled(spark, tmp_path):
    rows = raw(spark, {"Sta": "11"}, {"Sta": "11"})
    folder = str(tmp_path)
    load.write_dimensions(rows, folder, [])
    text = load.convert_once_each(rows, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in text and "Exchange hashpartitioning" not in text


def test_strict_fails_on_a_repeated_id(spark, tmp_path):
    rows = raw(spark, {"Sta": "11"})
    with pytest.raises(Exception, match="rejected row: duplicate_id"):
        load.load_star(rows.unionByName(rows), str(tmp_path), strict=True)


def test_open_rejects_search_the_accepted_rows_for_rejected_ids_only(spark, tmp_path):
    folder = str(tmp_path)
    load.load_star(raw(spark, {"Sta": "11"}, {"Sta": "11", "Value": "x"}, *[{"Sta": "11"} for _ in range(200)]), folder)
    found = load.open_rejects(spark, folder)
    text = found._jdf.queryExecution().optimizedPlan().toString().replace(" ", "")
    assert "JoinLeftSemi,(transaction_id" in text  # below the aggregation: only matching rows are grouped
    assert text.index("good_seq") < text.index("JoinLeftSemi")
    assert values(found, "transaction_id") == [(1,)]
