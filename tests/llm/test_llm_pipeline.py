import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import oracle  # noqa: E402
from llm_fixtures import frame  # noqa: E402
from test_llm_decontaminate import d as decontaminate  # noqa: E402
from test_llm_mixing import check as check_mix  # noqa: E402
from test_llm_ngram import brute as near  # noqa: E402
from test_llm_ngram import crowd  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from farelens.llm import ngram_join, quality_fm  # noqa: E402
from farelens.llm.common import table  # noqa: E402
from farelens.llm.queries import ORACLES, QUERIES  # noqa: E402


def test_stages_one_by_one(spark, sf_dir):
    """Each stage against a plain version over what the stage before kept."""
    docs = table(spark, sf_dir, "documents")
    scores = {r.doc_id: r.predicted for r in quality_fm.score_quality(docs, table(spark, sf_dir, "labels")).collect()}
    rows = {r.doc_id: r for r in docs.collect() if scores[r.doc_id] == 1}
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality classifier"](spark, docs, sf_dir)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(rows)

    best = {}
    for r in rows.values():
        best[r.text] = max(best.get(r.text, -1), r.doc_id)
    kept = stages["exact dedup"](spark, spark.createDataFrame(list(rows.values()), docs.schema), sf_dir)
    rows = {i: rows[i] for i in best.values()}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(rows)

    kept = stages["n-gram Jaccard join"](spark, spark.createDataFrame(list(rows.values()), docs.schema), sf_dir)
    classes = near([(i, r.text) for i, r in rows.items()], 5, 80)
    rows = {i: r for i, r in rows.items() if classes[i][1] == i}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(rows)

    kept = stages["benchmark decontamination"](spark, spark.createDataFrame(list(rows.values()), docs.schema), sf_dir)
    passages = [decontaminate.normalised(r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    exact = {i for i, r in rows.items() if any(p in decontaminate.normalised(r.text) for p in passages)}
    left = {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns and exact.isdisjoint(left) and len(left) >= len(rows) - len(exact) - 2
    rows = {i: rows[i] for i in left}

    mixed = stages["mixing sources to target weights"](spark, spark.createDataFrame(list(rows.values()), docs.schema), sf_dir)
    check_mix([tuple(r) for r in rows.values()], [r for r in mixed.collect()])
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(str, whole)) == sorted(map(str, mixed.collect()))


def test_near_copies_of_a_large_family(spark, monkeypatch):
    """The third stage settles a family larger than a task's share, in many classes, in few rounds."""
    rounds = []
    real = ngram_join._round
    monkeypatch.setattr(ngram_join, "_round", lambda *args: rounds.append(1) or real(*args))
    monkeypatch.setattr(ngram_join, "GROUP", 6)
    monkeypatch.setattr(ngram_join, "SHORT_LIST", 3)
    rows = crowd(40, 3, 9) + [(1, "alone")]
    docs = frame(spark, rows)
    classes = near(rows, 5, 80)
    want = {i for i, (_, c) in classes.items() if i == c}
    kept = corpus_pipeline.near_copies(spark, docs, "")
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == want
    assert len(want) > 10 and len(rounds) <= 4


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and set(QUERIES) <= set(names)
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert set(ORACLES) <= set(QUERIES) and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    assert oracle.compare(QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), ORACLES[name]) is None


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, "/root/testdata/sf0.001", name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_the_rest_does_not_import_the_text_operators():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for folder, _, names in os.walk(os.path.join(root, "farelens")):
        if os.sep + "llm" in folder:
            continue
        for name in names:
            if name.endswith(".py"):
                assert "llm" not in open(os.path.join(folder, name)).read().split("import")[-1].lower() or "farelens.llm" not in open(
                    os.path.join(folder, name)
                ).read()
