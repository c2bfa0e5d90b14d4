import datetime as dt

import pytest
from fixtures import star, trip, values

from farelens.plans import marts
from farelens.schemas import EXTRACT_COLUMNS, LINE_SCHEMA
from farelens.session import build_session, drop_staged, fresh_path, shared_folder, stage
from farelens.sources import extracts, tables
from farelens.streaming.landing import land_new_files

HEADER = ",".join(EXTRACT_COLUMNS)
ROW = '7,10,North,"",,Red,R,NCMC,Entry,Adult,12.50,"x, ""y""",2024-05-01 08:30:00'


def write(path, *lines, encoding="utf-8", end="\n"):
    path.write_bytes((end.join(lines) + end).encode(encoding))
    return str(path)


def test_landing_keeps_text_verbatim(spark, tmp_path):
    landed = extracts.land_raw(spark, write(tmp_path / "a.csv", HEADER, ROW))
    row = landed.collect()[0]
    assert (row.trx_id, row.Sta, row.Value, row.TrxDetail) == (7, "10", "12.50", 'x, "y"')
    assert row.Dest == "" and row.ingested_at is not None and row.corrupt_record is None


def test_unquoted_empty_field_is_blank(spark, tmp_path):
    landed = extracts.land_raw(spark, write(tmp_path / "a.csv", HEADER, ROW.replace('""', "", 1)))
    assert values(landed, "Dest") == [(None,)]


def test_malformed_line_is_kept(spark, tmp_path):
    landed = extracts.land_raw(spark, write(tmp_path / "a.csv", HEADER, "1,2", ROW)).cache()
    assert values(landed.where("corrupt_record IS NOT NULL"), "corrupt_record") == [("1,2",)]
    assert landed.count() == 2


def test_other_column_order_fails_instead_of_swapping(spark, tmp_path):
    swapped = HEADER.replace("Sta,station_name", "station_name,Sta")
    with pytest.raises(Exception, match="(?i)header"):
        extracts.land_raw(spark, write(tmp_path / "a.csv", swapped, ROW)).collect()


def test_rows_without_an_id_get_one(spark, tmp_path):
    columns = EXTRACT_COLUMNS[1:]
    path = write(tmp_path / "a.csv", ",".join(columns), *[ROW.partition(",")[2]] * 3)
    ids = values(extracts.land_raw(spark, path, columns), "trx_id")
    assert len(set(ids)) == 3
    other = write(tmp_path / "b.csv", ",".join(columns), *[ROW.partition(",")[2]] * 3)
    assert sorted(values(extracts.land_raw(spark, path, columns), "trx_id")) == sorted(ids)
    assert set(ids).isdisjoint(values(extracts.land_raw(spark, other, columns), "trx_id"))


def test_chunks_without_ids(spark, tmp_path):
    columns = EXTRACT_COLUMNS[1:]
    inbox, raw, state = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "state")
    inbox.mkdir()
    for name in "ab":
        write(inbox / f"{name}.csv", ",".join(columns), *[ROW.partition(",")[2]] * 2, "1,2")
        land_new_files(spark, str(inbox), raw, state, files_per_chunk=1, columns=columns).awaitTermination()
    landed = spark.read.parquet(raw)
    assert landed.count() == landed.select("trx_id").distinct().count() == 6
    assert values(landed.where("corrupt_record IS NOT NULL"), "corrupt_record") == [("1,2",)] * 2
    batch = extracts.land_raw(spark, str(inbox), columns)
    assert sorted(values(batch, "trx_id")) == sorted(values(landed, "trx_id"))


def test_flat_import_types_names_and_encoding(spark, tmp_path):
    row = "7,10,Café €,11,South,Red,R,NCMC,Entry,Adult,12.50,x,2024-05-01 08:30:00"
    path = write(tmp_path / "a.csv", HEADER, row, row.replace(",11,", ",,"), encoding="windows-1252", end="\r\n")
    flat = extracts.import_flat_extract(spark, path)
    assert "Ticket Type" in flat.columns and "Station" in flat.columns
    assert values(flat, "Station", "Dest", "Value", "InsertionDateTime") == [
        ("Café €", 11, 12.5, dt.date(2024, 5, 1)),
        ("Café €", None, 12.5, dt.date(2024, 5, 1)),
    ]


def test_dimension_files(spark, tmp_path):
    lines = write(
        tmp_path / "l.csv", "line_id,line_name,line_colour_cc,revenue_share_target_pct", "1,Red,R,51.16", end="\r\n"
    )
    stations = write(
        tmp_path / "s.csv", "station_id,station_name,line_id,line_name,is_interchange", "12,North,1,Red,TRUE", end="\r\n"
    )
    assert values(extracts.read_lines(spark, lines)) == [(1, "Red", "R", 51.16)]
    assert values(extracts.read_stations(spark, stations)) == [(12, "North", 1, "Red", True)]


def test_extract_round_trip(spark):
    built = star(spark, [trip("2024-05-01", 10, None, 1, 1, "2.50"), trip("2024-05-02", 12, 11, 2, 3, "3.00")])
    path = fresh_path(spark, "round-trip")
    tables.write_extract_csv(marts.flat_extract(built), path)
    back = extracts.import_flat_extract(spark, path)
    assert sorted(values(back, "transaction_id", "Sta", "Station", "Dest", "Line", "Ticket Type", "Value")) == [
        (0, 10, "North", None, "Red", "NCMC", 2.5),
        (1, 12, "East", 11, "Blue", "Other", 3.0),
    ]


def test_date_filter_skips_month_folders(spark, tmp_path):
    days = [f"2024-{month:02d}-{day:02d}" for month in range(1, 13) for day in (1, 15)]
    path = str(tmp_path / "fact")
    tables.write_fact(star(spark, [trip(day, 10, 11, 1, 1, "1.00") for day in days]).fact, path)
    fact = tables.read_fact(spark, path)
    picked = fact.where(tables.days(fact, "2024-03-02", "2024-04-20"))
    assert picked.count() == 3
    assert len(picked.inputFiles()) <= 24
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "txn_month" in plan.split("PartitionFilters")[1].split("]")[0]


def test_a_month_is_written_as_few_files(spark, tmp_path):
    path = tmp_path / "fact"
    fact = star(spark, [trip("2024-05-01", 10, 11, 1, 1, "1.00")] * 200).fact.repartition(8)
    tables.write_fact(fact, str(path))
    assert len(list(path.rglob("*.parquet"))) == 1


def test_statistics_of_a_catalogue_table(spark):
    spark.createDataFrame([(1, "Red", "R", True)], LINE_SCHEMA).write.mode("overwrite").saveAsTable("stat_lines")
    tables.refresh_statistics(spark, "stat_lines")
    described = dict(r[:2] for r in spark.sql("DESCRIBE EXTENDED stat_lines").collect())
    assert "1 rows" in described["Statistics"]
    spark.sql("DROP TABLE stat_lines")


def test_chunked_landing_takes_each_file_once(spark, tmp_path):
    inbox, raw, state = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "state")
    inbox.mkdir()

    def run():
        land_new_files(spark, str(inbox), raw, state, files_per_chunk=1).awaitTermination()
        return spark.read.parquet(raw).count()

    write(inbox / "a.csv", HEADER, ROW)
    write(inbox / "b.csv", HEADER, ROW)
    assert run() == 2
    assert run() == 2
    write(inbox / "c.csv", HEADER, ROW, ROW)
    assert run() == 4


def test_staged_tables_are_dropped(spark, tmp_path):
    folder = str(tmp_path)
    assert stage(spark.range(3), "numbers", folder).count() == 3 and list(tmp_path.rglob("*.parquet"))
    drop_staged(spark, folder)
    assert not list(tmp_path.rglob("*.parquet"))


def test_shared_folder_is_the_session_setting(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert build_session() is not None
    assert stage(spark.range(3), "three").count() == 3


def test_statistics_decide_a_join_side(spark, tmp_path):
    """With column statistics Catalyst knows that a filter leaves few rows, and broadcasts that side."""
    names = ["stats_fact", "stats_days"]
    spark.range(200_000).selectExpr("id", "id % 5000 AS day", "repeat('x', 40) AS pad").write.option("path", str(tmp_path / "a")).saveAsTable(names[0])
    spark.range(200_000).selectExpr("id AS day", "repeat('y', 40) AS pad").write.option("path", str(tmp_path / "b")).saveAsTable(names[1])
    settings = {"spark.sql.cbo.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "200000"}
    before = {key: spark.conf.get(key) for key in settings}
    query = "SELECT count(*) FROM stats_fact f JOIN stats_days d ON f.day = d.day WHERE d.day BETWEEN 100 AND 300"
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)

        def chosen():
            return spark.sql(query)._jdf.queryExecution().sparkPlan().toString()

        assert "SortMergeJoin" in chosen()
        for name in names:
            tables.refresh_statistics(spark, name)
        assert "BroadcastHashJoin" in chosen()
        known = {r["column_name"]: r for r in tables.table_statistics(spark, "stats_days").collect()}
        assert known["day"]["row_count"] == 200_000 and known["day"]["has_histogram"] and not known["pad"]["has_histogram"]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
