import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
from llm_fixtures import AWKWARD, frame, words  # noqa: E402

from farelens.llm import mixing  # noqa: E402


def brute_targets(sizes):
    """Sizes by source; the excess is shared again until no target is above its limit."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not over:
            out |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def check(rows, got):
    size = {}
    for r in rows:
        size.setdefault(r[3], []).append(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")))
    want = brute_targets({s: sum(x) for s, x in size.items()})
    assert sorted((r.doc_id, r["size"]) for r in got) == sorted(
        (r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in rows
    )
    for s, target in want.items():
        own = [r for r in got if r.source == s]
        assert {r.source_size for r in own} == {sum(size[s])}
        assert all(r.target == pytest.approx(target) for r in own)
        assert abs(sum(r.taken for r in own) - target) <= max(size[s], default=0)
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    assert all(r.taken % r["size"] == 0 if r["size"] else r.taken == 0 for r in got)


def test_awkward_rows(spark):
    check(AWKWARD, mixing.mix(frame(spark, AWKWARD)).collect())


def test_many_documents_meet_their_targets_closely(spark):
    rows = [(i, words(5 + i % 90, i), None, ["hot", "hot", "b", "c", "d", None][i % 6]) for i in range(3000)]
    got = mixing.mix(frame(spark, rows)).collect()
    check(rows, got)
    for s in {r[3] for r in rows}:
        own = [r for r in got if r.source == s]
        assert sum(r.taken for r in own) == pytest.approx(own[0].target, abs=60)


def test_same_result_however_partitioned(spark):
    rows = [(i % 40, words(3 + i % 11, i % 40), None, "ab"[i % 2]) for i in range(400)]
    a = mixing.mix(frame(spark, rows).repartition(1)).collect()
    b = mixing.mix(frame(spark, rows[::-1]).repartition(7, "text")).collect()
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) == 400


def test_empty_table_and_empty_texts(spark):
    assert mixing.mix(frame(spark, [])).collect() == []
    got = mixing.mix(frame(spark, [(1, None, None, "a"), (2, "", None, "b")])).collect()
    assert [(r.target, r.taken) for r in got] == [(0.0, 0), (0.0, 0)]


def test_expectation_is_kept(spark):
    """Over some seeds a document is taken as often as its target asks for."""
    rows = [(i, words(4 + i, i), None, "a") for i in range(6)] + [(10 + i, words(9, i), None, "b") for i in range(6)]
    total, expected = {}, {}
    for seed in range(4):
        for r in mixing.mix(frame(spark, rows), seed=seed).collect():
            total[r.doc_id] = total.get(r.doc_id, 0) + r.taken / r["size"] / 4
            expected[r.doc_id] = r.target / r.source_size
    assert sum(total.values()) == pytest.approx(sum(expected.values()), rel=0.25)


def test_many_sources(spark):
    """One source per host: thousands of targets by sums over a table, some sources far larger than others."""
    import random

    rng = random.Random(8)
    sizes = {f"host{i:05d}": rng.choice([0, 1, 5, 40, 1000]) + rng.randint(0, 9) for i in range(3000)} | {None: 500_000, "z": 900}
    table = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n long")
    got = {r.source: r.target for r in mixing.targets(table, 1.5, (3, 1, 2), 2).collect()}
    want = brute_targets(sizes)
    assert set(got) == set(want) and all(got[s] == pytest.approx(want[s]) for s in want)
