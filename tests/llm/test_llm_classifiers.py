import os
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from llm_fixtures import AWKWARD, frame  # noqa: E402

from farelens.llm import quality_fm, toxicity_cnn  # noqa: E402
from farelens.llm.common import table  # noqa: E402

LABELS = "doc_id long, quality int, toxic int"
CASES = [(quality_fm.score_quality, "quality", 4, 2), (toxicity_cnn.score_toxicity, "toxic", 3, 1)]


def auc(scores, truth):
    a = np.array(scores)[np.array(truth) == 1]
    b = np.array(scores)[np.array(truth) == 0]
    return (a[:, None] > b[None]).mean() + 0.5 * (a[:, None] == b[None]).mean()


@pytest.mark.parametrize("score, label, parts, rest", CASES)
def test_held_out_accuracy(spark, score, label, parts, rest):
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels")
    got = score(table(spark, sf, "documents"), labels).collect()
    truth = {r.doc_id: r[label] for r in labels.collect()}
    assert len(got) == table(spark, sf, "documents").count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == rest) for r in got)
    assert all(r.predicted == int(r.score >= 0.7) for r in got)
    test = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in test]) > 0.97
    assert auc([r.score for r in test], [truth[r.doc_id] for r in test]) > 0.96


@pytest.mark.parametrize("score, label, parts, rest", CASES)
def test_only_the_text_counts(spark, sf_dir, score, label, parts, rest):
    """Other ids of unlabelled rows, other languages and sources give the same scores; null text is empty text."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    unlabelled = docs.join(labels, "doc_id", "left_anti")
    changed = unlabelled.selectExpr("doc_id + 100000 doc_id", "text", "'xx' lang", "null source", "n_chars", "1 extra")
    labelled = docs.join(labels, "doc_id", "left_semi").selectExpr("doc_id", "text", "'yy' lang", "'z' source", "n_chars", "2 extra")
    a = {r.doc_id: r.score for r in score(docs, labels).collect()}
    b = {r.doc_id % 100000: r.score for r in score(labelled.unionByName(changed), labels).collect()}
    assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], abs=1e-9) for i in a)


@pytest.mark.parametrize("score, label, parts, rest", CASES)
def test_awkward_rows(spark, sf_dir, score, label, parts, rest):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    odd = frame(spark, [(r[0] + 10**6, *r[1:]) for r in AWKWARD] + [(None, "no id")]).select("doc_id", "text", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    odd_labels = spark.createDataFrame([(None, 1, 1), (5, None, None), (10**9, 0, 0)], LABELS)
    got = score(docs.unionByName(odd), labels.unionByName(odd_labels)).collect()
    assert len(got) == docs.count() + len(AWKWARD) + 1 and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert by_id[10**6 + 8] == by_id[10**6 + 9] and by_id[10**6 + 1] == by_id[10**6 + 2]


@pytest.mark.parametrize("score, label, parts, rest", CASES)
def test_too_few_labels(spark, score, label, parts, rest):
    docs = frame(spark, AWKWARD)
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in score(docs, none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 1) for i in range(1, 12)], LABELS)
    assert {r.score for r in score(docs, ones).collect()} == {1.0}
    both = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 12)], LABELS)
    assert len(score(docs, both).collect()) == len(AWKWARD)
    assert score(frame(spark, []), ones).collect() == []


def test_interactions_in_linear_time_equal_the_sum_over_pairs():
    rng = np.random.RandomState(1)
    model = quality_fm.FactorisationMachine()
    model.v = rng.normal(0, 1, model.v.shape)
    model.w = rng.normal(0, 1, model.w.shape)
    ids, x = np.array([3, 50, 700, 65540]), rng.normal(0, 1, 4)
    pairs = sum(model.v[ids[i]] @ model.v[ids[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    raw, _ = model.raw(ids, x, np.array([0]))
    assert raw[0] == pytest.approx(model.w[ids] @ x + pairs)


def test_look_up_tables_equal_a_plain_convolution():
    rng = np.random.RandomState(2)
    model = toxicity_cnn.TextCnn()
    model.e[:-1] = rng.normal(0, 1, (toxicity_cnn.PAD, toxicity_cnn.DIM))
    lengths = [1, 2, 9]
    texts = []
    for n in lengths:
        body = rng.randint(0, toxicity_cnn.BUCKETS, (n, 3)) + np.arange(3) * toxicity_cnn.BUCKETS
        texts.append(np.concatenate([body, np.full((2, 3), toxicity_cnn.PAD)]).astype(np.int32))
    got, _, _ = model.pooled(texts, model.tables())
    for row, text in zip(got, texts, strict=True):
        v = model.e[text].sum(1)
        want = []
        for w in toxicity_cnn.WIDTHS:
            answers = [sum(v[t + j] @ model.f[w][j] for j in range(w)) for t in range(len(text) - w + 1)]
            want.append(np.max(answers, 0) + model.fb[w])
        assert row == pytest.approx(np.concatenate(want), abs=1e-4)
