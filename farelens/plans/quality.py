"""Checks on the star schema and on samples drawn from it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelens.functions.numeric import as_decimal, fare_total, mean, percent
from farelens.operators.lookups import label
from farelens.operators.trends import count_share, share_of_total
from farelens.plans.marts import line_totals
from farelens.schemas import Star

REQUIRED = [
    "transaction_id", "txn_timestamp", "txn_date", "origin_station_id", "line_id", "passenger_type_id", "fare_amount"
]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _check(rows: DataFrame, name: str, count: Column) -> DataFrame:
    return rows.agg(F.coalesce(count, F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(name).alias("check_name"), "violations"
    )


def _used_keys(fact: DataFrame, keys: dict[str, str], also: Sequence[Column] = ()) -> DataFrame:
    """(name, key, n): how often each value of each key column occurs, all from one scan.

    Keys are text and blank keys stay. The row without a name holds the totals ``also``.
    """
    columns = list(dict.fromkeys(keys.values()))
    sets = [[column] for column in columns] + ([[]] if also else [])
    counted = fact.groupingSets(sets, *columns).agg(
        F.count("*").alias("n"), *also, *[F.grouping(column).alias(f"without_{column}") for column in columns]
    )
    parts = [
        F.struct(
            F.lit(name).alias("name"),
            F.col(column).cast("string").alias("key"),
            (F.col(f"without_{column}") == 0).alias("own"),
        )
        for name, column in keys.items()
    ]
    total = F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("key"), F.lit(True).alias("own"))
    own = F.filter(F.array(*parts), lambda part: part["own"])
    each = F.explode(F.when(F.size(own) > 0, own).otherwise(F.array(total)))
    totals = [column for column in counted.columns if column not in columns and not column.startswith("without_") and column != "n"]
    return counted.select(each.alias("part"), "n", *totals).select("part.name", "part.key", "n", *totals)


def integrity_report(star: Star) -> DataFrame:
    """Violations of NOT NULL, fare >= 0, unique keys and the foreign keys, one row per rule.

    Two scans of the fact: one counts every key column's values and the column rules, one finds repeated
    ids. Only distinct key values meet the dimensions.
    """
    fact = star.fact
    foreign = {
        "fk:origin_station_id": (star.stations, "origin_station_id", "station_id"),
        "fk:dest_station_id": (star.stations, "dest_station_id", "station_id"),
        "fk:line_id": (star.lines, "line_id", "line_id"),
        "fk:passenger_type_id": (star.passenger_types, "passenger_type_id", "passenger_type_id"),
        "fk:txn_date": (star.dates, "txn_date", "date_key"),
    }
    rules = [F.count_if(F.col(name).isNull()).alias(f"not_null:{name}") for name in REQUIRED]
    rules.append(F.count_if(F.col("fare_amount") < 0).alias("fare_not_negative"))
    used = _used_keys(fact, {name: key for name, (_, key, _) in foreign.items()}, rules)
    known = _union(
        [dim.select(F.lit(name).alias("name"), F.col(key).cast("string").alias("key")) for name, (dim, _, key) in foreign.items()]
    ).distinct()
    names = [f"not_null:{name}" for name in REQUIRED] + ["fare_not_negative"]
    # Each key value is weighed once; the row of totals carries the column rules.
    weighed = used.join(known.withColumn("known", F.lit(True)), ["name", "key"], "left").select(
        F.explode(
            F.when(F.col("name").isNull(), F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"`{n}`").alias("n")) for n in names]))
            .otherwise(
                F.array(
                    F.struct(
                        F.col("name").alias("check_name"),
                        F.when(F.col("known").isNull() & F.col("key").isNotNull(), F.col("n")).otherwise(F.lit(0)).alias("n"),
                    )
                )
            )
        ).alias("r")
    )
    checks = [*names, *foreign]
    listed = F.explode(F.array(*[F.lit(name) for name in checks])).alias("check_name")
    every = fact.sparkSession.range(1).select(listed)
    counted = weighed.groupBy("r.check_name").agg(F.sum("r.n").alias("n"))
    parts = [
        every.join(counted, "check_name", "left").select("check_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("violations"))
    ]
    unique = {
        "unique:transaction_id": (fact, "transaction_id"),
        "unique:line_name": (star.lines, "line_name"),
        "unique:passenger_type": (star.passenger_types, "passenger_type"),
        "unique:station_id": (star.stations, "station_id"),
    }
    for name, (table, key) in unique.items():
        repeated = table.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
        parts.append(_check(repeated, name, F.count("*")))
    return _union(parts)


def profile(star: Star) -> DataFrame:
    """Footfall, revenue and shares by line, passenger type and day, and the network total.

    The look-ups keep unmatched keys under a blank member, so all four share one scan of the fact.
    """
    keys = ["line_id", "passenger_type_id", "txn_date"]
    cube = star.fact.groupBy(*keys).agg(F.count("*").alias("n"), fare_total().alias("fare"))
    sums = [F.sum("n").alias("footfall"), F.sum("fare").alias("revenue")]
    lines = label(cube.groupBy("line_id").agg(*sums), star.lines, "line_id", "line_id", "left", member="line_name")
    types = label(
        cube.groupBy("passenger_type_id").agg(*sums),
        star.passenger_types,
        "passenger_type_id",
        "passenger_type_id",
        "left",
        member="passenger_type",
    )
    days = cube.groupBy(F.col("txn_date").cast("string").alias("member")).agg(*sums)
    network = cube.groupBy(F.lit("all").alias("member")).agg(*sums)
    named = {"line": lines, "passenger_type": types, "day": days, "network": network}
    return _union(
        [
            rows.select(
                F.lit(name).alias("profile"),
                "member",
                "footfall",
                "revenue",
                count_share("footfall").alias("footfall_pct"),
                share_of_total(F.col("revenue")).alias("revenue_pct"),
            )
            for name, rows in named.items()
        ]
    )


def days_covered(star: Star) -> DataFrame:
    """One row: days with sales and average revenue per such day."""
    daily = star.fact.groupBy("txn_date").agg(fare_total().alias("revenue"))
    return daily.agg(
        F.count("*").alias("days_covered"),
        mean(F.sum("revenue"), F.count("*"), 2).alias("daily_avg_revenue"),
    )


def share_against_target(star: Star, targets: DataFrame) -> DataFrame:
    """Revenue share of each line next to its target share; ``targets`` is keyed by line name."""
    actual = line_totals(star).select("line_name", "revenue", share_of_total(F.col("revenue")).alias("share_pct"))
    target = F.col("revenue_share_target_pct").cast("decimal(9,2)")
    return actual.join(targets.select("line_name", target.alias("target_pct")), "line_name").withColumn(
        "difference_pct", F.col("share_pct") - F.col("target_pct")
    )


def _shares(counts: DataFrame, key: str, name: str) -> DataFrame:
    members = counts.groupBy(F.col(key).cast("string").alias("member")).agg(F.sum("n").alias("n"))
    return members.select("member", count_share("n").alias(name))


def sample_validation(full: DataFrame, sample: DataFrame, line: str = "line_id") -> DataFrame:
    """Share of each hour and line in the sample against the full data, in percentage points.

    Full data and sample are each reduced to hour and line once; both profiles come from that.
    """
    strata = [F.hour("txn_timestamp").alias("hour"), F.col(line).alias("line")]
    whole, part = (df.groupBy(*strata).agg(F.count("*").alias("n")) for df in (full, sample))
    parts = []
    for name in ("hour", "line"):
        both = _shares(whole, name, "full_pct").join(_shares(part, name, "sample_pct"), "member", "left")
        missing = F.lit(0).cast(both.schema["sample_pct"].dataType)
        parts.append(
            both.select(F.lit(name).alias("profile"), "member", "full_pct", F.coalesce("sample_pct", missing).alias("sample_pct"))
        )
    return _union(parts).withColumn("abs_diff_pct", F.abs(F.col("full_pct") - F.col("sample_pct")))


def worst_difference(validation: DataFrame) -> DataFrame:
    return validation.groupBy("profile").agg(
        F.count("*").alias("members"), F.max("abs_diff_pct").alias("max_abs_diff_pct")
    )


def sample_distance(full: DataFrame, sample: DataFrame, line: str = "line_id") -> DataFrame:
    """How far the sample's hour and line profiles are from the full data's, per profile.

    chi_square: sum of (sampled - expected)^2 / expected over the members, expected in proportion to the full
    data; about ``degrees`` for a sample that differs only by chance. ks_distance: largest difference of the two
    cumulative shares, members in order. Members that the full data lacks don't occur in a sample of it.
    """
    strata = [F.hour("txn_timestamp").alias("hour"), F.col(line).alias("line")]
    whole, part = (df.groupBy(*strata).agg(F.count("*").alias(name)) for df, name in ((full, "n"), (sample, "k")))
    both = whole.join(part, whole["hour"].eqNullSafe(part["hour"]) & whole["line"].eqNullSafe(part["line"]), "left").select(
        whole["hour"], whole["line"], "n", F.coalesce("k", F.lit(0)).alias("k")
    )
    member = F.explode(
        F.array(*[F.struct(F.lit(name).alias("profile"), F.col(name).cast("bigint").alias("member")) for name in ("hour", "line")])
    )
    counts = both.select(member.alias("m"), "n", "k").groupBy("m.profile", "m.member").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    every = Window.partitionBy("profile")
    upto = every.orderBy("member")
    n_all, k_all = F.sum("n").over(every), F.sum("k").over(every)
    expected = F.col("n") * k_all.cast("double") / n_all
    gap = F.abs(F.sum("n").over(upto) / n_all - F.sum("k").over(upto) / k_all)
    measured = counts.select("profile", ((F.col("k") - expected) ** 2 / expected).alias("term"), gap.alias("gap"))
    return measured.groupBy("profile").agg(
        (F.count("*") - 1).alias("degrees"), F.sum("term").alias("chi_square"), F.max("gap").alias("ks_distance")
    )


def estimated_revenue(full: DataFrame, sample: DataFrame, line: str = "line_id", z: float = 1.96) -> DataFrame:
    """One row: revenue estimated from a sample that is drawn per line and hour, and its interval.

    Each stratum's sampled mean stands for all its rows; the variance adds up over strata, with the correction
    for finite strata. Strata of one sampled row have no variance of their own and are counted in ``unmeasured``;
    strata that the sample lacks are counted in ``missing`` and add nothing.
    """
    strata = [F.col(line).alias("line"), F.hour("txn_timestamp").alias("hour")]
    cents = (F.col("fare_amount") * 100).cast("bigint")
    whole = full.groupBy(*strata).agg(F.count("fare_amount").alias("n"), F.sum(cents).alias("t"))
    part = sample.groupBy(*strata).agg(
        F.count("fare_amount").alias("k"), F.sum(cents).alias("s"), F.var_samp(cents.cast("double")).alias("spread")
    )
    both = whole.join(part, whole["line"].eqNullSafe(part["line"]) & whole["hour"].eqNullSafe(part["hour"]), "left")
    n, k, s = (F.col(name).cast("double") for name in ("n", "k", "s"))
    variance = F.when(F.col("k") > 1, n * (n - k) / k * F.col("spread"))
    sums = both.agg(
        F.sum("t").alias("t"),
        F.sum(n * s / k).alias("estimate"),
        F.sum(variance).alias("variance"),
        F.count_if(F.col("k") == 1).alias("unmeasured"),
        F.count_if(F.coalesce("k", F.lit(0)) == 0).alias("missing"),
    )
    error = F.sqrt("variance") / 100
    return sums.select(
        (F.col("t") / 100).alias("revenue"),
        (F.col("estimate") / 100).alias("estimated_revenue"),
        error.alias("standard_error"),
        (F.abs(F.col("estimate") - F.col("t")) / 100 <= error * z).alias("inside_interval"),
        "unmeasured",
        "missing",
    )


def reconcile_totals(star: Star) -> DataFrame:
    """Rounded average ticket times footfall against revenue, within half a cent per row."""
    totals = star.fact.agg(F.count("*").alias("footfall"), fare_total().alias("revenue"))
    average = mean(F.col("revenue"), F.col("footfall"), 2)
    rebuilt = average.cast("decimal(18,2)") * as_decimal(F.col("footfall"))
    gap = F.abs(F.col("rebuilt_revenue") - F.col("revenue"))
    return (
        totals.withColumns({"avg_ticket_value": average, "rebuilt_revenue": rebuilt})
        .withColumn("gap_pct", percent(gap, F.col("revenue"), 4))
        .withColumn("is_reconciled", gap <= as_decimal(F.col("footfall")) * F.lit("0.005").cast("decimal(4,3)"))
    )


def blank_members(star: Star) -> DataFrame:
    """Transactions that fall on a blank label after a left look-up, per dimension; one scan of the fact."""
    roles = {
        "line": ("line_id", star.lines, "line_id", "line_name"),
        "origin_station": ("origin_station_id", star.stations, "station_id", "station_name"),
        "destination_station": ("dest_station_id", star.stations, "station_id", "station_name"),
        "passenger_type": ("passenger_type_id", star.passenger_types, "passenger_type_id", "passenger_type"),
    }
    used = _used_keys(star.fact, {name: key for name, (key, *_) in roles.items()})
    known = _union(
        [
            dim.where(F.col(text).isNotNull()).select(F.lit(name).alias("name"), F.col(key).cast("string").alias("key"))
            for name, (_, dim, key, text) in roles.items()
        ]
    ).distinct()
    listed = F.explode(F.array(*[F.lit(name) for name in roles])).alias("dimension")
    counted = (
        used.join(known.withColumn("known", F.lit(True)), ["name", "key"], "left")
        .groupBy(F.col("name").alias("dimension"))
        .agg(F.sum(F.when(F.col("known").isNull(), F.col("n"))).alias("blank"), F.sum("n").alias("n"))
    )
    return (
        star.fact.sparkSession.range(1)
        .select(listed)
        .join(counted, "dimension", "left")
        .select("dimension", F.coalesce("blank", F.lit(0)).alias("blank_rows"), F.coalesce("n", F.lit(0)).alias("all_rows"))
    )


def average_ticket_against_target(star: Star, target: str) -> DataFrame:
    """One row: the average ticket value next to the profile's target."""
    totals = star.fact.agg(F.count("fare_amount").alias("paid"), fare_total().alias("revenue"))
    average = mean(F.col("revenue"), F.col("paid"), 2).cast("decimal(18,2)")
    wanted = F.lit(target).cast("decimal(9,2)")
    return totals.select(
        F.col("paid").alias("transactions"),
        average.alias("avg_ticket_value"),
        wanted.alias("target_avg_ticket_value"),
        (average - wanted).alias("difference"),
    )
