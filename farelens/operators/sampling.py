"""Repeatable stratified sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelens.session import stage

SPAN = 1 << 52  # values of the hash; as fine as a rate held in a double


def place(id_column: str, salt: str = "") -> Column:
    """A number from 0 to 2^52 - 1 from the whole id: ids with structure spread like any others."""
    text = F.col(id_column).cast("string")
    digest = F.md5((F.concat(F.lit(salt), text) if salt else text).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


def stratified_sample(
    df: DataFrame,
    id_column: str,
    rate: float = 0.2,
    strata: Column | Sequence[Column] | None = None,
    rates: Mapping[object, float] | None = None,
) -> DataFrame:
    """Keep a row when the hash of its id falls below its stratum's rate.

    A filter without shuffle, and the same rows on every run. ``rates`` overrides ``rate`` for
    single strata: values of the ``strata`` expression, or tuples of values of several.
    """
    limit = F.lit(round(rate * SPAN))
    if strata is not None and rates:
        columns = [strata] if isinstance(strata, Column) else list(strata)
        chosen = F
        for value, own in rates.items():
            values = [value] if isinstance(strata, Column) else value
            matches = reduce(lambda a, b: a & b, [c == F.lit(v) for c, v in zip(columns, values, strict=True)])
            chosen = chosen.when(matches, F.lit(round(own * SPAN)))
        limit = chosen.otherwise(limit)
    return df.where(place(id_column) < limit)


SPAN_BITS = 52
STEP_BITS = 12


def quotas(counts: DataFrame, strata: Sequence[str], rate: float) -> DataFrame:
    """Rows (strata, n, quota) from (strata, n): ``rate`` of all rows, dealt by size with largest remainders.

    The rows left after rounding down go to the largest remainders, ties to the stratum that sorts first.
    """
    size = F.floor(F.sum("n").over(Window.partitionBy()) * F.lit(rate) + 0.5).cast("decimal(38,0)")
    share = size * F.col("n")
    everything = F.sum("n").over(Window.partitionBy()).cast("decimal(38,0)")
    dealt = counts.withColumns({"size": size, "down": F.floor(share / everything).cast("bigint"), "over": F.pmod(share, everything)})
    left = F.col("size") - F.sum("down").over(Window.partitionBy())
    order = Window.orderBy(F.col("over").desc(), *[F.col(name).asc_nulls_first() for name in strata])
    more = (F.row_number().over(order) <= left).cast("bigint")
    return dealt.select(*strata, "n", (F.col("down") + more).alias("quota"))


def exact_sample(
    df: DataFrame, id_column: str, strata: Mapping[str, Column], rate: float = 0.2, salt: str = "", largest: int = 100_000
) -> DataFrame:
    """Rows of each stratum with the smallest hashes of their ids, exactly the stratum's quota of them.

    Finds each stratum's threshold by counting, never by sorting a stratum: hashes are counted by their leading
    bits, the step in which the quota ends is counted by the next bits, until such a step has at most
    ``largest`` rows, and only those are ranked. The sample is then a filter. Ids must be unique; the same
    rows give the same sample in any layout. ``strata`` maps names to expressions.
    """
    names = list(strata)
    ids = df.select(*[column.alias(name) for name, column in strata.items()], place(id_column, salt).alias("place"), id_column)
    counts = ids.groupBy(*names).agg(F.count("*").alias("n"))
    # need: how many rows the stratum still lacks when all before the step are taken.
    state = stage(
        quotas(counts, names, rate).where("quota > 0").select(*names, F.lit(0).cast("bigint").alias("step"), F.col("quota").alias("need")),
        "sample-steps",
    )
    bits = 0
    while True:
        inside = _matched(ids, state, names).where(F.shiftright("place", SPAN_BITS - bits) == F.col("step"))
        bits += STEP_BITS
        finer = inside.groupBy(*names, "need", F.shiftright("place", SPAN_BITS - bits).alias("finer")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy(*names).orderBy("finer"))  # at most 2^12 rows each
        ending = finer.withColumn("upto", upto).where("upto >= need AND upto - n < need")
        state = stage(
            ending.select(*names, F.col("finer").alias("step"), (F.col("need") - F.col("upto") + F.col("n")).alias("need"), "n"),
            "sample-steps",
        )
        if bits + STEP_BITS > SPAN_BITS or (state.agg(F.max("n")).first()[0] or 0) <= largest:
            break
    last = _matched(ids, state.drop("n"), names).where(F.shiftright("place", SPAN_BITS - bits) == F.col("step"))
    ranked = last.withColumn("rank", F.row_number().over(Window.partitionBy(*names).orderBy("place", id_column)))
    limits = stage(
        ranked.where("rank = need").select(
            *[F.col(name).alias(f"limit_{name}") for name in names], F.col("place").alias("limit_place"), F.col(id_column).alias("limit_id")
        ),
        "sample-limits",
    )
    same = reduce(lambda a, b: a & b, [column.eqNullSafe(F.col(f"limit_{name}")) for name, column in strata.items()])
    within = F.struct(place(id_column, salt), F.col(id_column)) <= F.struct("limit_place", "limit_id")
    return df.join(limits, same & within, "left_semi")


def _matched(ids: DataFrame, state: DataFrame, names: Sequence[str]) -> DataFrame:
    known = state.withColumnsRenamed({name: f"state_{name}" for name in names})
    same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"state_{name}")) for name in names])
    return ids.join(known, same).drop(*[f"state_{name}" for name in names])


def bernoulli_by_stratum(df: DataFrame, column: str, rates: Mapping[object, float], seed: int) -> DataFrame:
    """Spark's own ``sampleBy``: depends on the partitioning, so not repeatable across layouts."""
    return df.sampleBy(column, dict(rates), seed)
