"""Mixes sources to target sizes by pivotal dependent rounding, in DataFrame operations only.

A source's target over its size is the number of copies each of its documents should get; the whole part
is certain, the fraction is the document's probability of one copy more. Two documents of a source at a
time exchange expected words until one of them is certain to be taken or left, in a random direction
that keeps every document's expectation. Words given equal words received, so a block of documents
ends with at most one uncertain document and keeps its expected size. The uncertain ones of 64 blocks
meet in the next round, a reduction tree per source; the last one of a source goes to the nearer end.

Sources take weights 3, 1, 2, repeating, in code point order, null last; a target stops at ``limit``
times the source's size and the excess is shared by weight among the others. Null text has size 0, and
documents of size 0 are taken 0 words. Repeated rows are separate documents. The same rows give the
same result, however they are partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelens.session import stage

WORD = r"[^\x20\x09-\x0D]+"
FAN_IN = 64


def targets(sizes: DataFrame, share: float, weights: tuple[int, ...], limit: int) -> DataFrame:
    """Rows (source, source_size, n, target) from (source, source_size, n); one row per source.

    A shared level, times its weight, is a source's target until its limit. The level starts as if no source
    had a limit and rises with what the limited ones leave over, until no further source reaches its limit.
    Sources may be many (one per host, say): they are numbered within sorted ranges, and the level needs sums only.
    """
    parts = max(1, min(int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1024))
    order = F.col("source").asc_nulls_last()
    ranged = stage(sizes.repartitionByRange(parts, order).withColumn("part", F.spark_partition_id()), "mix-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("part").agg(F.count("*").alias("held")).select(
        "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start")
    )
    position = F.col("start") + F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(position, F.lit(len(weights))).cast("int") + 1)
    placed = ranged.join(F.broadcast(starts), "part").withColumn("weight", weight)  # a row a range
    placed = stage(placed.withColumn("cap", F.col("source_size") * limit).drop("part", "start"), "mix-weights")
    everything = (placed.agg(F.sum("source_size")).first()[0] or 0) * share
    level, limited = 0.0, -1
    while True:
        full = F.col("cap") <= F.col("weight") * F.lit(level)
        found = placed.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("open"),
            F.count_if(full).alias("limited"),
        ).first()
        if found["limited"] == limited or not found["open"]:
            break
        level, limited = (everything - found["taken"]) / found["open"], found["limited"]
    shared = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(float(level)))
    if not found["open"]:
        shared = F.col("cap").cast("double")
    return placed.select("source", "source_size", "n", shared.alias("target"))


def _settle(seed: int) -> Column:
    """Folds a block's documents into (those taken, the uncertain one); see the module's text."""

    def step(state: Column, doc: Column) -> Column:
        held = state["open"]
        chance = F.pmod(
            F.xxhash64(held["doc_id"], held["copy"], doc["doc_id"], doc["copy"], F.lit(seed)), F.lit(1 << 30)
        ) / F.lit(float(1 << 30))
        up = F.least(held["words"] - held["mass"], doc["mass"])  # held gains, doc loses
        down = F.least(held["mass"], doc["words"] - doc["mass"])
        gains = chance * (up + down) < down

        def with_mass(unit: Column, mass: Column) -> Column:
            return unit.withField("mass", mass)

        nobody = F.lit(None).cast(UNIT)
        none = F.array().cast(f"array<{UNIT}>")
        sure = held["words"] - held["mass"] <= doc["mass"]
        left_over = doc["mass"] - (held["words"] - held["mass"])
        full = doc["words"] - doc["mass"] <= held["mass"]
        held_left = held["mass"] - (doc["words"] - doc["mass"])

        def result(taken: Column, still: Column) -> Column:
            return F.struct(F.concat(state["taken"], taken).alias("taken"), still.alias("open"))

        gain = F.when(sure, result(F.array(held), F.when(left_over > 0, with_mass(doc, left_over)).otherwise(nobody))).otherwise(
            result(none, with_mass(held, held["mass"] + doc["mass"]))
        )
        lose = F.when(full, result(F.array(doc), F.when(held_left > 0, with_mass(held, held_left)).otherwise(nobody))).otherwise(
            result(none, with_mass(doc, doc["mass"] + held["mass"]))
        )
        return (
            F.when(held.isNull(), F.struct(state["taken"].alias("taken"), doc.alias("open")))
            .when(gains, gain)
            .otherwise(lose)
        )

    start = F.struct(F.array().cast(f"array<{UNIT}>").alias("taken"), F.lit(None).cast(UNIT).alias("open"))
    return F.aggregate("block_docs", start, step)


UNIT = "struct<order:bigint,doc_id:bigint,copy:bigint,words:double,mass:double>"


def mix(
    docs: DataFrame,
    share: float = 1.5,
    weights: tuple[int, ...] = (3, 1, 2),
    limit: int = 2,
    seed: int = 7,
) -> DataFrame:
    """Per document: doc_id, size, source, source_size, target, taken. ``docs`` has doc_id, text, source."""
    counted = docs.select(
        F.col("doc_id").cast("long"),
        F.col("source").cast("string"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    # Rows alike in all three are interchangeable; numbering them makes the result repeatable.
    units = stage(
        counted.groupBy("doc_id", "source", "size")
        .count()
        .select("doc_id", "source", "size", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("copy")),
        "mix-units",
    )
    by_source = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    plan = stage(targets(by_source, share, weights, limit), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    planned = (
        units.withColumnRenamed("source", "s")
        .join(plan, F.col("s").eqNullSafe(F.col("source")))
        .withColumn("sure", F.floor(rate))
        .withColumn("part", rate - F.col("sure"))
        .select("doc_id", "size", "copy", "source", "source_size", "target", "n", "sure", "part")
    )
    blocks = F.ceil(F.col("n") / FAN_IN)
    level = planned.where("size > 0 and part > 0").select(
        "source",
        F.pmod(F.xxhash64("doc_id", "copy", F.lit(seed)), blocks).alias("block"),
        F.struct(
            (-F.col("size")).alias("order"),
            "doc_id",
            "copy",
            F.col("size").cast("double").alias("words"),
            (F.col("size") * F.col("part")).alias("mass"),
        ).alias("doc"),
    )
    width = plan.agg(F.max(blocks)).first()[0] or 0
    taken = []
    while True:
        grouped = level.groupBy("source", "block").agg(F.sort_array(F.collect_list("doc")).alias("block_docs"))
        settled = stage(
            grouped.select("source", "block", F.col("block_docs"), _settle(seed).alias("state")).select(
                "source", "block", "state"
            ),
            "mix-level",
        )
        taken.append(settled.select("source", F.explode("state.taken").alias("doc")))
        level = settled.where("state.open is not null").select(
            "source", F.floor(F.col("block") / FAN_IN).alias("block"), F.col("state.open").alias("doc")
        )
        if width <= 1:
            break
        width = -(-width // FAN_IN)
    taken.append(level.where("doc.mass * 2 >= doc.words").select("source", "doc"))  # one per source
    extra = taken[0]
    for more in taken[1:]:
        extra = extra.unionByName(more)
    chosen = extra.selectExpr("source ts", "doc.doc_id td", "doc.copy tc", "-doc.order tz", "1L extra")
    return planned.join(
        chosen,
        F.col("source").eqNullSafe(F.col("ts"))
        & F.col("doc_id").eqNullSafe(F.col("td"))
        & (F.col("copy") == F.col("tc"))
        & (F.col("size") == F.col("tz")),
        "left",
    ).select(
        "doc_id",
        "size",
        "source",
        "source_size",
        "target",
        (F.col("size") * (F.col("sure") + F.coalesce("extra", F.lit(0)))).alias("taken"),
    )
