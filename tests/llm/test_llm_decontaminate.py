import os
import random
import sys

from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(__file__))
from llm_fixtures import AWKWARD, edited, frame, words  # noqa: E402

from farelens.llm import decontaminate as d  # noqa: E402

ITEMS = "item_id long, text string, doc_id long"


def slow_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern):
        above, row = row, [i + 1]
        for j, c in enumerate(text):
            row.append(min(above[j] + (p != c), above[j + 1] + 1, row[j] + 1))
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.text("abc ", min_size=1, max_size=90), st.text("abc ", max_size=120))
def test_bit_parallel_distance(pattern, text):
    assert d.Pattern(0, pattern, 0.1).distance(text) == slow_distance(pattern, text)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(0, 14), st.sampled_from(["cut", "swap", "add"]))
def test_every_passage_within_budget_is_found(seed, edits, kind):
    import random

    rng = random.Random(seed)
    item = words(40, seed)
    passage = list(item)
    for at in sorted(rng.sample(range(len(passage)), edits), reverse=True):
        passage[at] = {"cut": "", "swap": "z", "add": passage[at] + "q"}[kind]
    text = d.normalised(words(30, seed + 1) + " " + "".join(passage) + " " + words(30, seed + 2))
    pattern = d.normalised(item)
    found = d.Searcher([(1, item)], 0.07, 240, 30).search(text)
    distance = slow_distance(pattern, text)
    budget = int(0.07 * len(pattern))
    assert found == ({1: distance} if distance <= budget else {})


def items(spark, n=3):
    return frame(spark, [(i, words(30 + i, 500 + i)) for i in range(n)], ITEMS)


def test_documents(spark):
    hit = words(31, 501)
    rows = AWKWARD + [
        (100, words(50, 9) + "\n" + hit.upper().replace(" ", "  ") + " " + words(50, 10)),
        (101, words(50, 9) + " " + edited(hit, 1, 3) + " " + words(50, 10)),
        (102, " ".join(hit.split(" ")[:12])),
        (103, hit + " " + words(30, 500)),
    ]
    for block in (2000, 1):
        got = {r.doc_id: r for r in d.find_contaminated(frame(spark, rows), items(spark), block=block).collect()}
        assert set(got) == {r[0] for r in rows}
        assert {i: (r.item_ids, r.min_distance) for i, r in got.items() if r.contaminated and i != 101} == {
            100: ([1], 0),
            103: ([0, 1], 0),
        }
        assert got[101].item_ids == [1] and got[101].min_distance > 0


def test_short_items_match_whole_words(spark):
    bench = frame(spark, [(1, "Cat hat"), (2, None), (3, " "), (4, "")], ITEMS)
    rows = [(1, "the cat  HAT sat"), (2, "cat hats"), (3, "bobcat hat"), (4, "cat hat"), (5, None)]
    got = d.find_contaminated(frame(spark, rows), bench).collect()
    assert sorted(r.doc_id for r in got if r.contaminated) == [1, 4] and len(got) == 5


def test_part_of_a_long_item(spark):
    long = words(200, 900)
    rows = [(1, words(40, 1) + " " + " ".join(long.split(" ")[:110])), (2, words(150, 2))]
    got = {r.doc_id: r.contaminated for r in d.find_contaminated(frame(spark, rows), frame(spark, [(7, long)], ITEMS)).collect()}
    assert got == {1: True, 2: False}


def test_empty_tables(spark):
    assert d.find_contaminated(frame(spark, []), items(spark)).collect() == []
    got = d.find_contaminated(frame(spark, AWKWARD), frame(spark, [], ITEMS)).collect()
    assert len(got) == len(AWKWARD) and not any(r.contaminated for r in got)
    docs = frame(spark, [(1, words(30, 500)), (2, "clean")])
    left = d.drop_contaminated(docs, items(spark))
    assert left.columns == docs.columns and [r.doc_id for r in left.collect()] == [2]


def test_item_that_repeats_a_phrase():
    rng = random.Random(5)
    letters = [rng.choice("abcdefghij") for _ in range(240)]
    cuts = [i * 240 // 17 for i in range(18)]  # 17 pieces for 16 edits
    letters[cuts[5] : cuts[6]] = letters[cuts[0] : cuts[1]]
    item = "".join(letters)
    copy = list(item)
    for piece in range(5):
        for step in (2, 6, 10):
            copy[cuts[piece] + step] = "#"
    text = "x" * 300 + "".join(copy) + "y" * 300
    assert d.Searcher([(1, item)], 0.07, 240, 30).search(text) == {1: 15}


def test_stage_with_null_ids_and_one_id_on_two_texts(spark):
    item = words(40, 77)
    rows = [(None, item), (None, "clean text"), (5, "before " + item), (5, "also clean"), (6, None)]
    bench = spark.createDataFrame([(1, item, None)], ITEMS)
    kept = d.drop_contaminated(frame(spark, rows), bench).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, "clean text"), (5, "also clean"), (6, "")]
