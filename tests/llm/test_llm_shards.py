"""Shards of the Hilbert curve: the curve itself, the laws of the cuts, awkward rows, and pruning."""

import zlib
from collections import Counter

import pytest
from llm_fixtures import AWKWARD, DOCS, frame, words
from pyspark.sql import functions as F

from farelens.llm.hilbert_shards import bounds, curve_index, hilbert_shards, write_shards


@pytest.mark.parametrize("n, bits", [(2, 4), (3, 3), (4, 3), (4, 4), (1, 5)])
def test_curve_visits_every_cell_and_moves_one_step_in_one_dimension(spark, n, bits):
    cells = spark.range(1 << n * bits).select(
        *[F.expr(f"cast(shiftright(id, {bits * i}) & {(1 << bits) - 1} AS int)").alias(f"d{i}") for i in range(n)]
    )
    found = cells.withColumn("at", curve_index([F.col(f"d{i}") for i in range(n)], bits)).orderBy("at").collect()
    assert [row["at"] for row in found] == list(range(1 << n * bits))
    for one, other in zip(found, found[1:]):
        assert sum(abs(one[f"d{i}"] - other[f"d{i}"]) for i in range(n)) == 1


def check(rows, docs, shards, law):
    """The contract, from the documents alone: ids, sizes, checksums, and every shard's slots without gaps."""
    wanted = Counter((d[0], len((d[1] or "").encode()) + 16, zlib.crc32((d[1] or "").encode())) for d in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == wanted
    slots = {}
    for r in rows:
        assert r["law"] == law and r["grown_shard"] is None and 0 <= r["shard"] < shards
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    ordered = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert all(a["curve"] <= b["curve"] for a, b in zip(ordered, ordered[1:]))  # runs of the curve
    return [[r for r in ordered if r["shard"] == s] for s in range(shards)]


def many(copies=300):
    hot = words(50, 1)
    docs = [(i, hot, "en", "a") for i in range(copies)]
    docs += [(1000 + i, words(5 + i % 90, i), ["en", "de", None][i % 3], f"s{i % 7}") for i in range(500)]
    docs += [(5000, "again", "en", "b")] * 250 + [(None, None, None, None)] * 3
    return docs


@pytest.mark.parametrize("block_rows", [7, 20_000])
def test_rows_are_at_most_one_apart(spark, block_rows):
    docs = many()
    parts = check(hilbert_shards(frame(spark, docs), block_rows=block_rows).collect(), docs, 40, "rows")
    sizes = [len(p) for p in parts]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(docs)


def test_bytes_are_equal_to_within_a_document(spark):
    docs = many()
    parts = check(hilbert_shards(frame(spark, docs), shards=8, law="bytes", block_rows=50).collect(), docs, 8, "bytes")
    sizes = [sum(r["size"] for r in p) for p in parts]
    share, longest = sum(sizes) / 8, max(r["size"] for p in parts for r in p)
    assert all(abs(s - share) <= longest for s in sizes)


def test_awkward_rows_and_any_partitioning(spark):
    docs = frame(spark, AWKWARD).withColumns({"shard": F.lit(1), "cell": F.lit("x"), "place": F.lit(2), "n": F.lit(0)})
    for law in ("rows", "bytes"):
        once, again = (
            sorted(tuple(map(str, r)) for r in hilbert_shards(d, law=law, block_rows=2).collect()) for d in (docs, docs.repartition(5))
        )
        assert once == again and len(once) == len(AWKWARD)
        check(hilbert_shards(docs, law=law, block_rows=2).collect(), AWKWARD, 40, law)


def test_empty_table(spark):
    for law in ("rows", "bytes"):
        assert hilbert_shards(spark.createDataFrame([], DOCS), law=law).count() == 0


def test_unknown_law_and_too_many_cells(spark):
    with pytest.raises(ValueError):
        hilbert_shards(frame(spark, AWKWARD), law="key")
    with pytest.raises(ValueError):
        hilbert_shards(frame(spark, AWKWARD), bits=5)


def test_bounds_cut_equal_steps_and_stand_extreme_numbers(spark):
    rows = spark.range(1000).select((F.col("id") + 10**12).alias("x"), F.format_string("%03d", "id").alias("s"))
    lows = bounds(rows, "x", 2)
    assert len(lows) == 3 and all(abs(low - 10**12 - 250 * (i + 1)) < 10 for i, low in enumerate(lows))
    assert bounds(rows, "s", 2) == ["250", "500", "750"]
    wide = spark.createDataFrame([(-(2**63),), (0,), (2**63 - 1,), (None,)], "x long")
    assert bounds(wide, "x", 2) == [0] or len(bounds(wide, "x", 2)) >= 1
    assert bounds(spark.createDataFrame([(None,)], "x long"), "x", 2) == []


def test_files_keep_all_columns_and_narrow_every_dimension(spark, tmp_path, sf_dir_larger):
    docs = spark.read.parquet(f"{sf_dir_larger}/documents.parquet").withColumn("slot", F.lit("kept"))
    path = str(tmp_path / "shards")
    write_shards(docs, path, shards=16, law="rows")
    back = spark.read.parquet(path)
    assert set(back.columns) == {*docs.columns, "slot_", "shard"}
    assert back.count() == docs.count() and back.where("slot = 'kept'").count() == docs.count()
    # Shards whose bounds let a filter on one dimension through: few for all three, where a sort serves only one.
    spans = back.groupBy("shard").agg(
        *[f(c).alias(f"{name}_{c}") for c in ("source", "n_chars", "doc_id") for name, f in (("lo", F.min), ("hi", F.max))]
    ).collect()
    for column, value in (("source", "src7"), ("doc_id", 321), ("n_chars", 400)):
        assert sum(r[f"lo_{column}"] <= value <= r[f"hi_{column}"] for r in spans) <= 12, column
