"""Stored aggregates of the fact, kept up to date load by load, and the choice of the smallest that serves.

Every load writes, beside its fact rows, sums of just those rows. Sums are additive, so the rows of all loads
together are the aggregate of the whole fact: a new load never reads what earlier ones hold, and a load
that replaces months hides their older sums by the same folder condition that hides their rows.
Distinct stations aren't additive; their sketches are mergeable and kept with the smallest aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.functions.numeric import TOTAL, fare_total
from farelens.schemas import FACT_SCHEMA, Rollup, Star
from farelens.sources import tables

STATION_ROLLUP, DAY_ROLLUP, PAIR_ROLLUP = "station_days", "line_days", "pair_days"

#: Name -> keys. The days of a line follow from the days of its stations.
STORED: dict[str, tuple[str, ...]] = {
    STATION_ROLLUP: ("txn_date", "line_id", "origin_station_id", "passenger_type_id"),
    DAY_ROLLUP: ("txn_date", "line_id"),
    PAIR_ROLLUP: ("txn_date", "origin_station_id", "dest_station_id", "passenger_type_id"),
}
SKETCH = "stations_sketch"
#: 2^12 registers: a relative standard error of about 1.6 %.
SKETCH_BITS = 12

_FIGURES = [
    T.StructField("rows", T.LongType()),
    T.StructField("paid", T.LongType()),
    T.StructField("revenue", T.DecimalType(20, 2)),
]


def _schema(name: str) -> T.StructType:
    sketch = [T.StructField(SKETCH, T.BinaryType())] if name == DAY_ROLLUP else []
    keys = [FACT_SCHEMA[key] for key in STORED[name]]
    return T.StructType([*keys, *_FIGURES, *sketch, *tables.PARTITIONS])


def add_up(rows: DataFrame, *keys: str | Column, extra: Iterable[Column] = ()) -> DataFrame:
    """rows, paid and revenue per combination of ``keys``, of transactions or of a rollup."""
    if "rows" in rows.columns:
        sums = [F.sum("rows").alias("rows"), F.sum("paid").alias("paid"), F.sum("revenue").cast(TOTAL).alias("revenue")]
    else:
        sums = [F.count("*").alias("rows"), F.count("fare_amount").alias("paid"), fare_total().alias("revenue")]
    return rows.groupBy(*keys).agg(*sums, *extra)


def station_sketch(stations: str = "origin_station_id") -> Column:
    """A mergeable sketch of the distinct stations."""
    return F.hll_sketch_agg(stations, F.lit(SKETCH_BITS))


def estimated_stations(rows: DataFrame) -> Column:
    """Aggregate: about how many stations ``rows`` have, merged from sketches where rows hold them."""
    sketch = F.hll_union_agg(SKETCH) if SKETCH in rows.columns else station_sketch()
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0))


def write_rollups(spark: SparkSession, folder: str, number: int) -> dict[str, int]:
    """Aggregates of the accepted rows that load ``number`` has written; their row counts."""
    own = tables.read_own(spark, folder, number)

    def path(name: str) -> str:
        return f"{folder}/rollups/{name}/load_seq={number}"

    def write(rows: DataFrame, name: str) -> None:
        tables.write_fact(rows.drop(tables.MONTH), path(name), dynamic=False)

    write(add_up(own, *STORED[STATION_ROLLUP]), STATION_ROLLUP)
    # A sketch knows only which stations there are, so it comes out the same from sums as from transactions.
    station_days = spark.read.schema(_schema(STATION_ROLLUP)).parquet(path(STATION_ROLLUP))
    write(add_up(station_days, *STORED[DAY_ROLLUP], extra=[station_sketch().alias(SKETCH)]), DAY_ROLLUP)
    write(add_up(own, *STORED[PAIR_ROLLUP]), PAIR_ROLLUP)
    return {name: spark.read.schema(_schema(name)).parquet(path(name)).count() for name in STORED}  # from file footers


def read_rollups(spark: SparkSession, folder: str) -> tuple[Rollup, ...]:
    """The stored aggregates, if every finished load has written its part of them."""
    loads = tables.read_loads(spark, folder)
    if not loads or any(load.rollup_rows is None for load in loads):
        return ()
    found = []
    for name, keys in STORED.items():
        rows = spark.read.schema(_schema(name)).parquet(f"{folder}/rollups/{name}")
        rows = rows.where(tables.visible(loads)).drop("load_seq")
        found.append(Rollup(frozenset({*keys, tables.MONTH}), rows, sum(load.rollup_rows[name] for load in loads)))
    return tuple(found)


def smallest(rollups: Sequence[Rollup], columns: Iterable[str]) -> Rollup | None:
    """The rollup with the fewest rows among those that hold all of ``columns``."""
    wanted = set(columns)
    serving = [rollup for rollup in rollups if wanted <= rollup.keys]
    return min(serving, key=lambda rollup: rollup.row_count, default=None)


def source(star: Star, columns: Iterable[str]) -> DataFrame:
    """What to read for figures per ``columns``: the smallest rollup that serves, or the fact."""
    chosen = smallest(star.rollups, columns)
    return star.fact if chosen is None else chosen.table


def totals(star: Star, *keys: str) -> DataFrame:
    """Footfall and revenue per combination of the fact's own ``keys``."""
    return add_up(source(star, keys), *keys).select(*keys, F.col("rows").alias("footfall"), "revenue")


def read_star(spark: SparkSession, folder: str) -> Star:
    """The star as the last finished load left it, with its stored aggregates."""
    return replace(tables.read_star(spark, folder), rollups=read_rollups(spark, folder))
