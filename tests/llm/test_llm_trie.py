"""The prefix trie against a trie of plain Python, for every size of shard and part."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from farelens.llm.prefix_trie import prefix_trie, regrown, turns_in_order, whole
from farelens.llm.queries import op13_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def originals(rows):
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [t[2:] for t in sorted(some)] for conv, some in turns.items()}


def rebuilt(turns):
    out = {}
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 6
        out[conv] = turns.get(conv - conv % 100, [])[:h] + own[h:]
    return out


def brute(turns):
    members, ends = defaultdict(list), defaultdict(list)
    for conv, own in turns.items():
        for depth in range(len(own) + 1):
            members[tuple(own[:depth])].append(conv)
        ends[tuple(own)].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) if children[node] else 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[c] for c in children[node])
    sha = lambda node: hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), len(children[n]), leaves[n], saved[n], sha(n))
        for n, m in members.items()
    )


def trie(conversations, **sizes):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    rows = prefix_trie(conversations, **sizes).select(*names).collect()
    return sorted(tuple(-1 if v is None else v for v in row) for row in rows)


def sample(seed):
    """Many shared prefixes, conversations that are equal or end inside others, some long ones."""
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(2000), 260):
        kind = rng.random()
        if kind < 0.3:
            turns = [("user", "hot"), ("assistant", "same äö"), ("user", "end")][: rng.choice([2, 3, 3])]
        else:
            turns = [(rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "ccc"])) for _ in range(rng.choice([1, 2, 5, 9, 40]))]
        numbers = sorted(rng.sample(range(5000), len(turns)))
        rows += [(conv, number, role, text) for number, (role, text) in zip(numbers, turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard, part", [(1, 40), (3, 200), (16, 90), (2048, 1 << 15)])
def test_equals_plain_trie(spark, shard, part):
    rows = sample(shard)
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = trie(whole(turns_in_order(table)), shard=shard, part_turns=part)
    assert found == brute(originals(rows))


@pytest.mark.parametrize("shard, part", [(2, 60), (2048, 1 << 15)])
def test_equals_plain_trie_when_regrown(spark, shard, part):
    rows = sample(100 + shard)
    table = spark.createDataFrame(rows, SCHEMA)
    found = trie(regrown(turns_in_order(table)), shard=shard, part_turns=part)
    assert found == brute(rebuilt(originals(rows)))


def test_query_on_the_given_table(spark, sf_dir_larger):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir_larger}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    frame = op13_prefix_trie(spark, sf_dir_larger)
    found = sorted(tuple(-1 if v is None else v for v in r) for r in frame.collect())
    assert found == brute(rebuilt(originals(rows)))
    assert frame.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_awkward_rows(spark):
    long = "x" * 100_000
    rows = [
        (None, 1, "user", "no conversation"),
        (100, None, None, None),
        (100, 2, "user", "a"),
        (100, 2, "user", "a"),  # a repeated row is a turn of its own
        (101, -5, "user", None),
        (101, 0, "assistant", long),
        (102, 1, "user", "tie"),
        (102, 1, "assistant", "tie"),
        (205, 3, "user", "1:x"),
        (206, 3, "use", "r1:x"),  # same letters, other cut
    ]
    table = spark.createDataFrame(rows, SCHEMA).withColumns({"pos": F.lit(9), "key": F.lit("k"), "block": F.lit(1)})
    for build, expected in ((whole, originals(rows)), (regrown, rebuilt(originals(rows)))):
        assert trie(build(turns_in_order(table))) == brute(expected)


def test_conversation_without_turns_is_a_member_of_the_root(spark):
    conv = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 1)
    table = spark.createDataFrame([(conv, 0, "user", "only")], SCHEMA)
    assert trie(regrown(turns_in_order(table))) == brute({conv: []})


def test_empty_table(spark):
    assert trie(regrown(turns_in_order(spark.createDataFrame([], SCHEMA)))) == []


def test_very_long_conversation_is_numbered_in_blocks(spark):
    rows = [(7, n * 3, "user", f"t{n % 50}") for n in range(6000)] + [(8, n, "user", f"t{n % 50}") for n in range(3000)]
    assert trie(whole(turns_in_order(spark.createDataFrame(rows, SCHEMA)))) == brute(originals(rows))
