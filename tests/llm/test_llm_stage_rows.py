"""The pipeline's stages decide by row: null ids, ids on several texts, repeated rows and clashing column names."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from llm_fixtures import frame, words  # noqa: E402

import corpus_pipeline  # noqa: E402
from farelens.llm import quality_fm  # noqa: E402
from farelens.llm.common import table  # noqa: E402

STAGES = dict(corpus_pipeline.STAGES)
FILTERS = list(STAGES)[:-1]
# Every name that a stage uses inside.
INSIDE = [
    "gone", "gone_id", "gone_sha", "gone_places", "row_number", "number", "name", "sha", "key", "body", "bucket", "depth", "owner",
    "chain", "keep_id", "group_size", "kept", "copies", "component_id", "n_shingles", "member", "order", "first", "score", "predicted",
    "declared", "h", "b", "s", "id", "n", "contaminated", "item_ids", "target", "size", "copy", "block", "taken",
]


def clashing(docs):
    return docs.withColumns({name: F.lit("x") for name in INSIDE if name not in docs.columns})


def kept(spark, docs, stage, sf_dir):
    out = STAGES[stage](spark, docs, sf_dir)
    assert out.columns == docs.columns
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"] or "") for r in out.collect())


@pytest.fixture(scope="module")
def odd(spark, sf_dir):
    """Sample documents, some without an id, some under another's id, some twice."""
    docs = table(spark, sf_dir, "documents")
    null = docs.where("doc_id % 10 = 3").withColumn("doc_id", F.lit(None).cast("long"))
    reused = docs.where("doc_id % 10 = 4").withColumn("doc_id", F.col("doc_id") + 1)
    again = docs.where("doc_id % 10 = 5")
    return docs.where("doc_id % 10 NOT IN (3, 4)").unionByName(null).unionByName(reused).unionByName(again)


def rows_of(docs):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"] or "") for r in docs.collect())


def test_quality_judges_each_row_by_its_text(spark, odd, sf_dir):
    labels = table(spark, sf_dir, "labels")
    fitted = quality_fm.train(odd, labels, "quality", 4, 2, 6000, 6)
    scored = quality_fm._scored(odd.withColumn("doc_id", F.col("text")), fitted).collect()
    bad = {r["doc_id"] or "" for r in scored if r["score"] < 0.7}
    want = [row for row in rows_of(odd) if row[1] not in bad]
    assert 0 < len(want) < odd.count()
    assert kept(spark, clashing(odd), "quality classifier", sf_dir) == want


def test_exact_keeps_one_row_of_each_text(spark, odd, sf_dir):
    best = {}
    for i, text in rows_of(odd):
        best[text] = max(best.get(text, -1), i)
    assert kept(spark, clashing(odd), "exact dedup", sf_dir) == sorted((i, text) for text, i in best.items())


def test_near_copies_leave_one_row_of_each_class(spark, sf_dir):
    w, z = words(60, 1), words(60, 2)
    docs = frame(spark, [(5, w), (5, z), (9, w + " x"), (2, z + " x"), (None, w + " y"), (None, words(60, 3)), (None, words(60, 3) + " x"), (7, None), (7, None)])
    found = kept(spark, clashing(docs), "n-gram Jaccard join", sf_dir)
    assert [row for row in found if row[0] != -1] == [(2, z + " x"), (5, w), (7, ""), (7, "")]
    assert len([row for row in found if row[0] == -1]) == 1


def test_contaminated_rows_go_whatever_their_id(spark, sf_dir):
    item = table(spark, sf_dir, "benchmark").first()["text"]
    clean = words(80, 5)
    docs = frame(spark, [(5, clean), (5, "x " + item), (None, item + " y"), (None, clean + " z"), (6, None)])
    found = kept(spark, clashing(docs), "benchmark decontamination", sf_dir)
    assert found == [(-1, clean + " z"), (5, clean), (6, "")]


def test_mixing_counts_each_row(spark, odd, sf_dir):
    mixed = STAGES["mixing sources to target weights"](spark, clashing(odd), sf_dir)
    assert mixed.count() == odd.count()
    sizes = sorted(len((r["text"] or "").split()) for r in odd.select("text").collect())
    assert abs(sum(sizes) - mixed.agg(F.sum("size")).first()[0]) < 0.01 * sum(sizes)


def test_pipeline_over_odd_rows(spark, odd, sf_dir, tmp_path):
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        table(spark, sf_dir, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    docs, left = clashing(odd), []
    for stage in FILTERS:
        docs = spark.createDataFrame(STAGES[stage](spark, docs, str(tmp_path)).collect(), docs.schema)
        left.append(docs.count())
    assert left == sorted(left, reverse=True) and left[-1] > 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == left[-1]
