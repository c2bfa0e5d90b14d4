"""Exact duplicates found through an extendible-hash index kept in the shared folder.

The directory has 2^16 slots addressed by the leading bits of a text's key. A bucket starts as the whole
key space and splits on its next bit (the directory doubles) while it holds more than ``capacity``
entries. An entry is one distinct text. Texts whose key no other row has take their place in the index as
they are. The others are routed by the directory to the owner of their bucket, an owner task having a run of
whole buckets; before they move, each map task makes one row of the copies it met, so a text that a third of
all rows hold arrives once a task. Owners read their buckets in key order, chain the texts of a key and
compare them byte by byte, and so form the groups; the index is what they write.

Null text counts as empty. Of equal texts the row with the largest id stays; a null id never wins over
an id. Rows that repeat id and text are one document, all counted in ``group_size``. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from farelens.llm.common import free_name, ship, without
from farelens.session import stage

SLOT_BITS = 16
KEY_BITS = 60
FILTER_SLOTS = 1 << 20
COLLAPSE_BYTES = 32 << 20
ROUTED = ["bucket", "depth", "key", "id", "n", "sha", "body"]


def directory(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int]]:
    """Buckets (first slot, slots, local depth) from the entries in each slot."""
    slots = sorted(counts)
    sums = [0]
    for slot in slots:
        sums.append(sums[-1] + counts[slot])
    done, todo = [], [(0, 0)]
    while todo:
        low, depth = todo.pop()
        width = 1 << (SLOT_BITS - depth)
        held = sums[bisect_left(slots, low + width)] - sums[bisect_left(slots, low)]
        if depth < SLOT_BITS and held > capacity:
            todo += [(low, depth + 1), (low + width // 2, depth + 1)]
        else:
            done.append((low, width, depth))
    return sorted(done)


def _keyed(docs: DataFrame, key_bits: int) -> DataFrame:
    """Columns id, body, sha, key; the key is the leading bits of the SHA-256, aligned to 60 bits."""
    sha = F.sha2(F.col("body"), 256)
    leading = F.conv(F.substring("sha", 1, 15), 16, 10).cast("long")
    cut = KEY_BITS - key_bits
    return (
        docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("body"))
        .withColumn("sha", sha)
        .withColumn("key", F.shiftleft(F.shiftright(leading, cut), cut))
    )


def _collapse(batches: Iterable[pa.RecordBatch], held_bytes: int = COLLAPSE_BYTES) -> Iterator[pa.RecordBatch]:
    """Copies that one map task meets become one row, with the largest id and their number."""
    held: dict[bytes, list] = {}
    size, schema = 0, None

    def flush() -> pa.RecordBatch:
        columns = list(zip(*held.values(), strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for batch in batches:
        schema = batch.schema
        names = schema.names
        for row in zip(*[batch.column(name).to_pylist() for name in names], strict=True):
            own = dict(zip(names, row, strict=True))
            known = held.get(own["body"])
            if known is None:
                held[own["body"]] = list(row)
                size += len(own["body"]) + 100
            else:
                known[names.index("id")] = _later(known[names.index("id")], own["id"])
                known[names.index("n")] += own["n"]
        if size > held_bytes:
            yield flush()
            held, size = {}, 0
    if held:
        yield flush()


def _later(one, other):
    return one if other is None or one is not None and one >= other else other


def chain(batches: Iterable[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
    """An owner's work: texts in order of bucket and key; those of one key are chained where their bytes differ.

    A key's distinct texts are held at a time, each once.
    """
    at, links, done = None, [], []

    def close() -> list[tuple]:
        ordered = sorted(links, key=lambda link: link[2])
        ordered.sort(key=lambda link: (link[0] is not None, 0 if link[0] is None else link[0]), reverse=True)  # null last
        return [(*at, place, sha, keep, n) for place, (keep, n, sha, _) in enumerate(ordered)]

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[] for _ in out]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out)

    for batch in batches:
        for bucket, depth, key, ident, n, sha, body in zip(*[batch.column(c).to_pylist() for c in ROUTED], strict=True):
            if (bucket, depth, key) != at:
                if links:
                    done += close()
                at, links = (bucket, depth, key), []
            for link in links:
                if link[3] == body:  # byte by byte; nothing else makes two texts one
                    link[0], link[1] = _later(link[0], ident), link[1] + n
                    break
            else:
                links.append([ident, n, sha, body])
        if len(done) > 10_000:
            yield as_batch(done)
            done = []
    if links:
        done += close()
    yield as_batch(done)


def build_index(docs: DataFrame, rows: DataFrame, capacity: int, key_bits: int) -> DataFrame:
    """The index table: bucket, depth, key, chain, sha, keep_id, group_size; one row per distinct text.

    ``rows`` holds (id, sha, key, n) per document. Texts alone on their key fill their places at once. The
    others are sent to the owners of their buckets, after each map task has made one row of the copies it met;
    owners form the groups. A broadcast list of at most 2^20 numbers keeps the texts that are alone from moving.
    """
    spark = docs.sparkSession
    ship(spark)
    slot = F.shiftright("key", KEY_BITS - SLOT_BITS)
    shared = stage(
        rows.groupBy("key").agg(F.sum("n").alias("n"), F.count_distinct("sha").alias("texts")).where("n > 1"), "exact-shared"
    )
    # Entries per slot: at most 2^16 rows. They say where the directory doubles.
    alone = rows.join(shared.select("key"), "key", "left_anti")
    counted = shared.select(slot.alias("s"), "texts").unionByName(alone.select(slot.alias("s"), F.lit(1).cast("long").alias("texts")))
    counts = {r["s"]: r["texts"] for r in counted.groupBy("s").agg(F.sum("texts").alias("texts")).collect()}
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = spark.createDataFrame(_owned(directory(counts, capacity), counts, parts), "s long, bucket long, depth int, owner int")
    slots = F.broadcast(slots)  # 2^16 rows at most
    placed = (
        alone.join(slots, slot == F.col("s"))
        .select("bucket", "depth", "key", F.lit(0).alias("chain"), "sha", F.col("id").alias("keep_id"), F.col("n").alias("group_size"))
    )
    number = F.pmod(F.xxhash64("key"), F.lit(FILTER_SLOTS))
    hot = F.broadcast(shared.select(number.alias("b")).distinct())
    moved = (
        _keyed(docs, key_bits)
        .withColumn("b", number)
        .join(hot, "b", "left_semi")
        .join(shared.select("key"), "key", "left_semi")
        .select("key", "id", F.lit(1).cast("long").alias("n"), "sha", F.col("body").cast("binary").alias("body"))
    )
    moved = moved.mapInArrow(_collapse, moved.schema)
    routed = moved.join(slots, slot == F.col("s")).select("owner", *ROUTED)
    types = StructType([placed.schema[name] for name in placed.columns])
    schema = to_arrow_schema(types)
    owned = routed.repartitionById(max(parts, 1), "owner").sortWithinPartitions("bucket", "key").select(*ROUTED)
    grouped = owned.mapInArrow(lambda batches: chain(batches, schema), types)
    return stage(placed.unionByName(grouped), "exact-index")


def _owned(buckets: list[tuple[int, int, int]], counts: dict[int, int], parts: int) -> list[tuple[int, int, int, int]]:
    """Rows (slot, bucket, depth, owner) of the slots in use; an owner has a run of whole buckets of about equal entries."""
    total, before, rows = sum(counts.values()), 0, []
    for low, width, depth in buckets:
        owner = min(before * parts // max(total, 1), parts - 1)
        for own in range(low, low + width):
            if own in counts:
                rows.append((own, low, depth, owner))
                before += counts[own]
    return rows


def exact_duplicates(docs: DataFrame, capacity: int = 100_000, key_bits: int = KEY_BITS) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256, copies (rows alike in id and text).

    ``docs`` has doc_id and text. Owners chain and compare texts; a document finds its group in the index.

    Fewer ``key_bits`` make keys collide more often; the result stays the same.
    """
    rows = stage(
        _keyed(docs, key_bits).groupBy("id", "sha", "key").agg(F.count("*").alias("n")), "exact-rows"
    )
    index = build_index(docs, rows, capacity, key_bits)
    # A text's hash finds its place in the chain; a key's members differ in their bytes.
    return (
        rows.join(index.select("key", "sha", "keep_id", "group_size"), ["key", "sha"])
        .select(
            F.col("id").alias("doc_id"),
            "keep_id",
            "group_size",
            F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.col("sha").alias("text_sha256"),
            F.col("n").alias("copies"),
        )
    )


def drop_exact_duplicates(docs: DataFrame, capacity: int = 100_000) -> DataFrame:
    """``docs`` with all its columns, one row for each distinct text: the one with the largest id, null last.

    Of rows that repeat id and text one stays.
    """
    found = stage(exact_duplicates(docs, capacity), "exact-result")

    def named(ident: Column, sha: Column) -> Column:  # an id may be null or stand on several texts
        return F.concat(sha, F.coalesce(F.concat(F.lit(" "), ident.cast("string")), F.lit("")))

    name = named(F.col("doc_id"), F.sha2(F.coalesce("text", F.lit("")), 256))
    found = found.withColumn("name", named(F.col("doc_id"), F.col("text_sha256")))
    left = without(docs, name, found.where("not kept").select("name"))
    repeated = found.where("kept and copies > 1").select("name")
    if repeated.isEmpty():
        return left
    key = free_name(docs, "name")
    several = left.withColumn(key, name).join(repeated.toDF(key), key, "left_semi").dropDuplicates([key])
    return without(left, name, repeated).unionByName(several.drop(key))
