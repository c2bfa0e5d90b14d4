import hashlib
import itertools
import os
import sys

import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from llm_fixtures import AWKWARD, DOCS, frame  # noqa: E402

from farelens.llm import exact_dedup  # noqa: E402


def brute(rows):
    docs = [(r[0], r[1] or "") for r in rows]
    groups = {}
    for i, t in docs:
        groups.setdefault(t, []).append(i)
    return {
        (i, max(groups[t]), len(groups[t]), i == max(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in docs
    }


@pytest.mark.parametrize("key_bits, capacity", [(60, 100_000), (2, 1), (0, 3), (20, 2)])
def test_equals_grouping_by_text(spark, key_bits, capacity):
    rows = AWKWARD + [(20 + i, "copy") for i in range(50)]
    got = exact_dedup.exact_duplicates(frame(spark, rows), capacity, key_bits).collect()
    assert {tuple(r)[:5] for r in got} == brute(rows)
    assert len(got) == len({(r[0], r[1] or "") for r in rows})


def test_empty_table(spark):
    assert exact_dedup.exact_duplicates(frame(spark, [])).collect() == []
    assert exact_dedup.drop_exact_duplicates(frame(spark, [])).collect() == []


def test_null_ids(spark):
    got = exact_dedup.exact_duplicates(frame(spark, [(None, "x"), (3, "x"), (None, "y")])).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in got} == {(None, 3, False), (3, 3, True), (None, None, True)}


def test_keeps_one_row_and_all_columns_of_each_text(spark):
    docs = frame(spark, AWKWARD)
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6, 7, 9, 10, 11]


def test_directory_splits_full_buckets_only():
    counts = {0: 5, 1: 5, 65535: 3}
    buckets = exact_dedup.directory(counts, 6)
    assert sum(width for _, width, _ in buckets) == 1 << exact_dedup.SLOT_BITS
    assert all(a[0] + a[1] == b[0] for a, b in itertools.pairwise(buckets))
    held = [sum(n for s, n in counts.items() if low <= s < low + width) for low, width, _ in buckets]
    assert max(held) <= 6 and len(buckets) == exact_dedup.SLOT_BITS + 1
    assert exact_dedup.directory({}, 5) == [(0, 1 << exact_dedup.SLOT_BITS, 0)]
    assert (7, 1, exact_dedup.SLOT_BITS) in exact_dedup.directory({7: 100}, 5)


def test_index_chains_colliding_texts(spark):
    docs = frame(spark, [(i, f"text {i % 7}") for i in range(20)])
    from farelens.session import stage
    from pyspark.sql import functions as F

    rows = stage(exact_dedup._keyed(docs, 0).groupBy("id", "sha", "key").agg(F.count("*").alias("n")), "t")
    index = exact_dedup.build_index(docs, rows, 100, 0).collect()
    assert sorted(r.chain for r in index) == list(range(7)) and {r.key for r in index} == {0}


def test_schema_of_documents_is_untouched():
    assert "node" in DOCS and "root" in DOCS  # names that the operators use inside


def test_stage_with_null_ids_and_one_id_on_two_texts(spark):
    rows = [(5, "A"), (9, "A"), (5, "B"), (None, "C"), (None, "C"), (None, "A"), (None, None), (None, "")]
    kept = exact_dedup.drop_exact_duplicates(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, ""), (0, "C"), (5, "B"), (9, "A")]


def routed(texts, bucket=0, key=0):
    rows = [(bucket, 0, key, i, 1, hashlib.sha256(t).hexdigest(), t) for i, t in enumerate(texts)]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], exact_dedup.ROUTED)


OUT = pa.schema(
    [("bucket", pa.int64()), ("depth", pa.int32()), ("key", pa.int64()), ("chain", pa.int32()), ("sha", pa.string())]
    + [("keep_id", pa.int64()), ("group_size", pa.int64())]
)


def test_owners_form_groups_by_comparing_bytes():
    batches = [routed([b"a", b"b", b"a"]), routed([b"b", b"c"]), routed([b"a"], key=1)]
    rows = pa.Table.from_batches(exact_dedup.chain(batches, OUT)).to_pylist()
    found = [(r["key"], r["chain"], r["keep_id"], r["group_size"]) for r in rows]
    assert sorted((key, keep, size) for key, _, keep, size in found) == [(0, 1, 1), (0, 1, 2), (0, 2, 2), (1, 0, 1)]
    assert [(key, place) for key, place, _, _ in found] == [(0, 0), (0, 1), (0, 2), (1, 0)]


def test_one_text_in_two_buckets_is_two_groups():
    """The directory decides what meets: a text that is routed wrongly isn't grouped with its copies."""
    rows = pa.Table.from_batches(exact_dedup.chain([routed([b"a"]), routed([b"a"], bucket=8)], OUT)).to_pylist()
    assert [r["group_size"] for r in rows] == [1, 1]


def test_map_tasks_collapse_copies():
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("sha", pa.string()), ("body", pa.binary())])
    rows = [(1, i if i % 3 else None, 1, "s", b"hot") for i in range(1000)] + [(2, 5, 1, "t", b"other")]
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    (out,) = exact_dedup._collapse([batch])
    assert sorted((r["id"], r["n"]) for r in out.to_pylist()) == [(5, 1), (998, 1000)]


def test_owners_have_runs_of_whole_buckets():
    counts = {s: 10 for s in range(0, 65536, 64)}
    rows = exact_dedup._owned(exact_dedup.directory(counts, 40), counts, 5)
    assert [r[0] for r in rows] == sorted(counts) and [r[3] for r in rows] == sorted(r[3] for r in rows)
    shares = [sum(1 for r in rows if r[3] == owner) for owner in range(5)]
    assert max(shares) - min(shares) <= 8 and all(len({r[3] for r in rows if r[1] == b}) == 1 for b in {r[1] for r in rows})
