import math

import pytest
from fixtures import values
from pyspark.sql import functions as F

from farelens.operators.sampling import bernoulli_by_stratum, exact_sample, quotas, stratified_sample
from farelens.operators.upsert import append_absent, insert_absent
from farelens.plans import quality


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(20_000).withColumn("stratum", (F.col("id") % 4).cast("int"))


def test_rate(rows):
    assert stratified_sample(rows, "id", 0.2).count() == pytest.approx(4000, abs=200)


def test_rates_have_no_floor(spark):
    rows = spark.range(1_000_000)
    assert stratified_sample(rows, "id", 0.00004).count() == pytest.approx(40, abs=20)
    assert stratified_sample(rows, "id", 0.00015).count() == pytest.approx(150, abs=40)


def test_ids_with_structure_lose_no_stratum(spark):
    rows = spark.range(24_000).selectExpr("id * 10000 + id % 24 AS id", "id % 24 AS hour")
    counts = dict(values(stratified_sample(rows, "id", 0.2).groupBy("hour").count()))
    assert len(counts) == 24 and all(n == pytest.approx(200, abs=60) for n in counts.values())


def test_rates_by_several_columns(rows):
    strata = [F.col("stratum"), F.col("id") % 2]
    sample = stratified_sample(rows, "id", 0.0, strata, {(1, 1): 1.0, (2, 1): 1.0})
    assert sample.count() == 5000


def test_same_rows_in_any_layout(rows):
    first = stratified_sample(rows, "id", 0.2)
    second = stratified_sample(rows.repartition(7), "id", 0.2)
    assert first.exceptAll(second).count() == 0


def test_rate_per_stratum(rows):
    sample = stratified_sample(rows, "id", 0.2, F.col("stratum"), {1: 0.5, 2: 0.0})
    counts = dict(values(sample.groupBy("stratum").count()))
    assert 2 not in counts and counts[1] == pytest.approx(2500, abs=150) and counts[0] == pytest.approx(1000, abs=120)


def test_no_shuffle_and_no_overflow(spark):
    top = 2**63 - 1
    frame = stratified_sample(spark.createDataFrame([(top,), (-top,)], "id long"), "id", 1.0)
    assert frame.count() == 2
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()


def test_spark_sampling_by_stratum(rows):
    sample = bernoulli_by_stratum(rows, "stratum", {0: 1.0, 1: 0.0, 2: 0.5, 3: 1.0}, seed=1)
    counts = dict(values(sample.groupBy("stratum").count()))
    assert counts[0] == counts[3] == 5000 and 1 not in counts


def test_insert_absent_keeps_the_existing_row(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    assert sorted(values(insert_absent(old, new, "k"))) == [(1, "a"), (2, "c")]


@pytest.mark.parametrize("partition", [None, "m"])
def test_replay_adds_nothing_twice(spark, partition):
    loaded = spark.createDataFrame([(1, "x"), (2, "y")], "transaction_id long, m string")
    batch = spark.createDataFrame([(2, "y"), (3, "y")], "transaction_id long, m string")
    assert values(append_absent(loaded, batch, partition=partition), "transaction_id") == [(3,)]


SKEWED = "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 7 = 0 THEN NULL ELSE id % 41 END"


@pytest.mark.parametrize("largest", [1, 50, 100_000])
def test_each_stratum_holds_exactly_its_quota(spark, largest):
    rows = spark.range(20_000).withColumn("s", F.expr(SKEWED))
    sample = exact_sample(rows, "id", {"s": F.col("s")}, 0.2, largest=largest)
    wanted = dict(values(quotas(rows.groupBy("s").agg(F.count("*").alias("n")), ["s"], 0.2), "s", "quota"))
    assert dict(values(sample.groupBy("s").count())) == {k: v for k, v in wanted.items() if v}
    assert sample.count() == 4000
    again = exact_sample(rows.repartition(9), "id", {"s": F.col("s")}, 0.2)
    assert sample.exceptAll(again).count() == 0 and sample.columns == rows.columns


def test_quotas_deal_the_remainder_to_the_largest(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 5), ("c", 4), (None, 1)], "s string, n bigint")
    assert dict(values(quotas(counts, ["s"], 0.5), "s", "quota")) == {"a": 3, "b": 3, "c": 2, None: 0}
    assert sum(q for _, q in values(quotas(counts, ["s"], 1.0), "n", "quota")) == 15


def test_exact_sample_of_nothing_and_of_everything(spark):
    rows = spark.range(50).withColumn("s", F.col("id") % 2)
    assert exact_sample(rows.limit(0), "id", {"s": F.col("s")}).count() == 0
    assert exact_sample(rows, "id", {"s": F.col("s")}, 1.0).count() == 50
    assert exact_sample(rows, "id", {"s": F.col("s")}, 0.0).count() == 0


def frame(spark, rows):
    return spark.createDataFrame(rows, "transaction_id long, line_id int, h int, fare double").selectExpr(
        "transaction_id", "line_id", "make_timestamp_ntz(2024, 1, 1, h, 0, 0) AS txn_timestamp", "cast(fare AS decimal(10,2)) AS fare_amount"
    )


def test_distances_of_a_hand_computed_case(spark):
    full = frame(spark, [(i, i % 2, 8, 1.0) for i in range(20)] + [(100 + i, 0, 9, 1.0) for i in range(20)])
    sample = frame(spark, [(i, 0, 8, 1.0) for i in range(6)] + [(10 + i, 0, 9, 1.0) for i in range(2)])
    found = {r["profile"]: r for r in quality.sample_distance(full, sample).collect()}
    # Hours: 20 and 20 of 40, sampled 6 and 2 of 8. Lines: 30 and 10 of 40, sampled 8 and 0.
    assert found["hour"]["chi_square"] == pytest.approx(4 / 4 + 4 / 4) and found["hour"]["ks_distance"] == pytest.approx(0.25)
    assert found["line"]["chi_square"] == pytest.approx(4 / 6 + 4 / 2) and found["line"]["ks_distance"] == pytest.approx(0.25)
    assert found["hour"]["degrees"] == 1


def test_estimate_of_a_hand_computed_case(spark):
    full = frame(spark, [(i, 0, 8, float(i)) for i in range(10)] + [(20, 1, 8, 7.0), (21, 1, 9, 5.0)])
    sample = frame(spark, [(1, 0, 8, 1.0), (4, 0, 8, 4.0), (20, 1, 8, 7.0)])
    (row,) = quality.estimated_revenue(full, sample).collect()
    assert row["revenue"] == pytest.approx(57.0) and row["estimated_revenue"] == pytest.approx(10 * 2.5 + 7)
    assert row["standard_error"] == pytest.approx(math.sqrt(10 * 8 / 2 * 4.5))
    assert (row["unmeasured"], row["missing"]) == (1, 1)


def test_intervals_cover_the_true_revenue(spark):
    """About 95 of 100 intervals hold it; 60 salts, each a sample of its own."""
    full = spark.range(2000).selectExpr(
        "id AS transaction_id", "cast(id % 3 AS int) AS line_id", "make_timestamp_ntz(2024, 1, 1, cast(id % 2 AS int), 0, 0) AS txn_timestamp",
        "cast(pmod(hash(id), 5000) / 100 AS decimal(10,2)) AS fare_amount",
    ).cache()
    from farelens.operators.sampling import place

    # Samples of one size each: the k smallest of the salted hashes, many salts in one job.
    salted = None
    for salt in range(60):
        rows = full.withColumns({"salt": F.lit(salt), "place": place("transaction_id", f"{salt}-")})
        salted = rows if salted is None else salted.unionByName(rows)
    from pyspark.sql import Window

    ranked = salted.withColumn("k", F.row_number().over(Window.partitionBy("salt", "line_id", F.hour("txn_timestamp")).orderBy("place")))
    chosen = ranked.where("k <= 60").cache()
    inside = sum(quality.estimated_revenue(full, chosen.where(F.col("salt") == salt)).first()["inside_interval"] for salt in range(0, 60, 2))
    assert 25 <= inside <= 30
