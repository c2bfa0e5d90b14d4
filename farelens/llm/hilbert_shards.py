"""Shards cut from a Hilbert curve over metadata, in DataFrame operations only.

1. Each dimension is quantised in 2^bits steps that hold about equally many rows and keep the dimension's
   order. A step's bounds come from a table of counts: for whole numbers by 64 steps an octave above the
   smallest value (some 4,000 rows at most), for text by value, the 65,536 most frequent ones.
2. The steps of all dimensions name a cell, of which there are at most 2^16. The Hilbert curve visits all
   cells so that neighbours on the curve are neighbours in one dimension: a run of the curve is a compact
   box-like region, and its files have narrow bounds in every dimension at once.
3. Rows are placed by cell along the curve, inside a cell by hash. A cell is split in blocks by that hash,
   and the blocks' counts are added up along the curve, so that a row's exact place in the whole order needs
   only its block: a hot source or a group of copies is spread over many blocks.
4. Places are cut in runs: of rows (shard sizes at most one apart) or of bytes (a shard ends within one
   document of its share).

A document's size is its text's UTF-8 bytes (null: none) plus 16. Null dimensions sort before all values.
Rows alike in id, size and checksum are counted as one with copies, and placed one after the other. Equal
texts keep no common shard: their metadata places them. An empty table gives an empty result, and fewer
rows than shards leave the last shards empty. Other columns are ignored (``write_shards`` keeps them). The
result depends only on the rows, not on how they are partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.llm.common import free_name, numbered
from farelens.session import stage

MAX_CELL_BITS = 16
DISTINCT = 1 << 16
BLOCK_ROWS = 20_000
HEAD = 16


def _shift_left(value: Column, by: Column | int) -> Column:
    return F.call_function("shiftleft", value, F.lit(by) if isinstance(by, int) else by)


def _shift_right(value: Column, by: Column | int) -> Column:
    return F.call_function("shiftright", value, F.lit(by) if isinstance(by, int) else by)


def curve_index(cell: Sequence[Column], bits: int) -> Column:
    """Place on the Hilbert curve of a cell, given by one number of ``bits`` bits per dimension.

    Walks from the highest bit down. The curve inside a sub-box is the whole curve turned: it enters at
    ``corner`` along ``axis``. One bit of every dimension, seen from there, is a number in Gray code.
    """
    n = len(cell)
    if n == 1:
        return cell[0].cast("int")
    gray = [i ^ (i >> 1) for i in range(1 << n)]
    rank = sorted(range(1 << n), key=gray.__getitem__)
    ones = [(~i & (i + 1)).bit_length() - 1 for i in range(1 << n)]  # trailing ones
    corner = [0] + [gray[(i - 1) // 2 * 2] for i in range(1, 1 << n)]
    turn = [0] + [ones[i if i % 2 else i - 1] % n for i in range(1, 1 << n)]

    def look(numbers: list[int], at: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in numbers]), at + 1)

    def turned(value: Column, by: Column, left: bool) -> Column:
        one, other = (_shift_left, _shift_right) if left else (_shift_right, _shift_left)
        return one(value, by).bitwiseOR(other(value, F.lit(n) - by)).bitwiseAND(F.lit((1 << n) - 1))

    def step(state: Column, level: Column) -> Column:
        picked = [_shift_left(_shift_right(c, level).bitwiseAND(F.lit(1)), i) for i, c in enumerate(cell)]
        seen = turned(reduce(Column.bitwiseOR, picked).bitwiseXOR(state["corner"]), state["axis"] + 1, left=False)
        at = look(rank, seen)
        return F.struct(
            state["corner"].bitwiseXOR(turned(look(corner, at), state["axis"] + 1, left=True)).alias("corner"),
            F.pmod(state["axis"] + look(turn, at) + 1, F.lit(n)).alias("axis"),
            _shift_left(state["index"], n).bitwiseOR(at).alias("index"),
        )

    start = F.struct(*[F.lit(0).alias(name) for name in ("corner", "axis", "index")])
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step)["index"]


def bounds(rows: DataFrame, dimension: str, bits: int) -> list:
    """Lowest values of the dimension's second and later steps: at most 2^bits - 1 of them, ascending."""
    known = rows.where(F.col(dimension).isNotNull())
    value = F.col(dimension)
    if isinstance(rows.schema[dimension].dataType, T.StringType):
        counts = known.groupBy(value.alias("value")).agg(F.count("*").alias("n"))
        counts = counts.orderBy(F.col("n").desc(), F.xxhash64("value"), "value").limit(DISTINCT)
    else:
        least = known.agg(F.min(value)).first()[0]
        above = F.coalesce(F.try_subtract(value.cast("long"), F.lit(least).cast("long")), F.lit((1 << 63) - 1))
        digits = F.length(F.bin(above))
        octave = digits * 128 + _shift_right(above, F.greatest(digits - 7, F.lit(0)))
        counts = known.groupBy(octave.alias("octave")).agg(F.min(value).alias("value"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("value").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    steps = counts.withColumn("step", F.floor(before * (1 << bits) / F.sum("n").over(Window.partitionBy())))
    found = steps.where("step > 0").groupBy("step").agg(F.min("value").alias("low")).orderBy("low")
    return [row["low"] for row in found.collect()]  # 2^bits - 1 rows at most


def _step_of(dimension: Column, lows: list) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce((dimension >= F.lit(low)).cast("int"), F.lit(0)) for low in lows], F.lit(0))


def _placed(rows: DataFrame, key: list[str], dimensions: Sequence[str], bits: int, block_rows: int) -> DataFrame:
    """``rows`` (key, size, n, dimensions) with curve and the rows and bytes that stand before each."""
    if len(dimensions) * bits > MAX_CELL_BITS:
        raise ValueError(f"{len(dimensions)} dimensions of {bits} bits are more than 2^{MAX_CELL_BITS} cells")
    steps = [_step_of(F.col(name), bounds(rows, name, bits)) for name in dimensions]
    cell = reduce(Column.bitwiseOR, [_shift_left(step, bits * i) for i, step in enumerate(steps)])
    units = rows.select(*key, "size", "n", cell.alias("cell"), F.xxhash64(*key).alias("h"))
    parts = [_shift_right(F.col("cell"), bits * i).bitwiseAND(F.lit((1 << bits) - 1)) for i in range(len(dimensions))]
    cells = units.groupBy("cell").agg(F.count("*").alias("units")).withColumn("curve", curve_index(parts, bits))
    # Blocks of about block_rows rows, and at most 2^16 more of them than cells.
    wide = F.greatest(F.lit(block_rows), F.ceil(F.sum("units").over(Window.partitionBy()) / DISTINCT))
    cells = stage(cells.select("cell", "curve", F.ceil(F.col("units") / wide).alias("blocks")), "shard-cells")
    units = units.join(F.broadcast(cells), "cell").withColumn("block", F.pmod("h", "blocks"))  # 2^16 rows at most
    counts = units.groupBy("curve", "block").agg(F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("size")).alias("bytes"))
    along = Window.orderBy("curve", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(
        counts.select("curve", "block", *[F.coalesce(F.sum(c).over(along), F.lit(0)).alias(f"{c}_start") for c in ("rows", "bytes")]),
        "shard-blocks",
    )
    inside = Window.partitionBy("curve", "block").orderBy("h", *key).rowsBetween(Window.unboundedPreceding, -1)

    def before(what: Column, start: str) -> Column:
        return F.col(start) + F.coalesce(F.sum(what).over(inside), F.lit(0))

    joined = units.join(F.broadcast(starts), ["curve", "block"])  # 2^17 rows at most
    return joined.select(
        *key, "size", "n", "curve",
        before(F.col("n"), "rows_start").alias("place"),
        before(F.col("n") * F.col("size"), "bytes_start").alias("byte"),
    )


def _cut(placed: DataFrame, shards: int, law: str) -> DataFrame:
    """One row per copy, with shard and slot."""
    total = placed.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") * F.col("size")), F.lit(0))).first()
    copies = placed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    copies = copies.withColumn("place", F.col("place") + F.col("copy")).withColumn("byte", F.col("byte") + F.col("copy") * F.col("size"))
    if law == "rows":
        share, more = divmod(total[0], shards)
        longer = more * (share + 1)  # places in the shards that take one more
        first = F.col("place") < longer
        rest = F.col("place") - longer
        shard = F.when(first, F.floor(F.col("place") / (share + 1))).otherwise(more + F.floor(rest / max(share, 1)))
        slot = F.when(first, F.pmod("place", F.lit(share + 1))).otherwise(F.pmod(rest, F.lit(max(share, 1))))
        return copies.withColumns({"shard": shard.cast("int"), "slot": slot.cast("long")})
    if law != "bytes":
        raise ValueError(f"law {law!r} is neither rows nor bytes")
    cut = stage(copies.withColumn("shard", F.expr(f"least(byte * {shards}L DIV {max(total[1], 1)}L, {shards - 1}L)").cast("int")), "shard-cut")
    starts = cut.groupBy("shard").agg(F.min("place").alias("start"))
    return cut.join(F.broadcast(starts), "shard").withColumn("slot", F.col("place") - F.col("start"))  # one row a shard


def _size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + HEAD


def hilbert_shards(
    docs: DataFrame,
    shards: int = 40,
    law: str = "rows",
    dimensions: Sequence[str] = ("source", "lang", "size", "doc_id"),
    bits: int = 4,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null), curve.

    ``dimensions`` are text or whole-number columns of ``docs``; ``size`` is the document's size.
    """
    own = [name for name in dimensions if name not in ("size", "doc_id")]
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    key = ["doc_id", "text_crc32", *own]
    rows = stage(
        docs.select("doc_id", _size().alias("size"), crc.alias("text_crc32"), *own)
        .groupBy(*key, "size")
        .agg(F.count("*").alias("n")),
        "shard-rows",
    )
    cut = _cut(stage(_placed(rows, key, dimensions, bits, block_rows), "shard-places"), shards, law)
    return cut.select(
        "doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )


def write_shards(
    docs: DataFrame,
    path: str,
    shards: int = 40,
    law: str = "bytes",
    dimensions: Sequence[str] = ("source", "lang", "size", "doc_id"),
    bits: int = 4,
    block_rows: int = BLOCK_ROWS,
) -> None:
    """Writes ``docs`` with all its columns as Parquet, a folder a shard, in the curve's order.

    The rows are numbered in a copy in the shared folder first, so that repeated rows stay apart.
    """
    shard, slot = (free_name(docs, name) for name in ("shard", "slot"))
    copy, number = numbered(docs, "shard-docs")
    own = [name for name in dimensions if name != "size"]
    rows = copy.select(F.col(number).alias("row"), _size().alias("size"), F.lit(1).cast("long").alias("n"), *own)
    placed = stage(_placed(rows, ["row"], dimensions, bits, block_rows), "shard-places")
    cut = _cut(placed, shards, law).select(F.col("row").alias(number), F.col("shard").alias(shard), F.col("slot").alias(slot))
    (
        copy.join(cut, number)
        .drop(number)
        .repartition(shards, shard)
        .sortWithinPartitions(shard, slot)
        .write.partitionBy(shard)
        .parquet(path)
    )

