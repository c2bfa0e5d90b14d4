import os
import random
import re
import sys

sys.path.insert(0, os.path.dirname(__file__))
from llm_fixtures import frame  # noqa: E402

from farelens.llm import quotes  # noqa: E402

TALK = "conv_id long, turn long, role string, text string, depth string, hash string"


def order(spark, rows):
    return {(r.conv_id, r.turn): r for r in quotes.reply_order(frame(spark, rows, TALK)).collect()}


def test_nested_quotes(spark):
    rows = [
        (1, 0, "user", "How do I  boil\nan egg?"),
        (1, 1, "assistant", "Ten minutes.\n\nIn salted water."),
        (1, 2, "user", "> Ten minutes.\nThat long?"),
        (1, 3, "assistant", ">> ten  MINUTES.\n> That long?\nYes.\n\n> > In salted water.\nAnd salt."),
        (1, 4, "user", "> How do I boil\n> an egg?\nThanks."),
        (2, 0, "user", "> That long?\nAsked elsewhere."),
        (2, 1, "assistant", "> nobody wrote this\nOwn words."),
        (3, 5, "user", "after a gap\n> That long?"),
        (3, 9, "user", ">That long?"),
    ]
    got = order(spark, rows)
    parent = {k: (r.parent_conv, r.parent_turn, r.reply) for k, r in got.items()}
    assert parent == {
        (1, 0): (None, None, "start"),
        (1, 1): (1, 0, "turn"),
        (1, 2): (1, 1, "quote"),
        (1, 3): (1, 2, "quote"),
        (1, 4): (1, 0, "quote"),
        (2, 0): (None, None, "start"),
        (2, 1): (2, 0, "turn"),
        (3, 5): (1, 2, "quote"),
        (3, 9): (1, 2, "quote"),
    }
    assert got[1, 3].text == "Yes.\n\nAnd salt." and got[1, 3].n_quotes == 3 and got[1, 3].n_linked == 3
    assert got[1, 4].text == "Thanks."
    assert {k: (r.thread_conv, r.thread_turn, r.depth) for k, r in got.items()}[1, 3] == (1, 0, 3)
    assert (got[3, 9].thread_conv, got[3, 9].depth) == (1, 3)
    ordered = sorted(got.values(), key=lambda r: (r.thread_conv, r.thread_turn, r.depth, r.conv_id, r.turn))
    place = {(r.conv_id, r.turn): i for i, r in enumerate(ordered)}
    assert all(r.parent_conv is None or place[r.parent_conv, r.parent_turn] < place[r.conv_id, r.turn] for r in ordered)


def test_common_text_points_to_the_latest_in_the_conversation(spark):
    rows = [(c, t, "user", "same words") for c in range(20) for t in range(0, 6, 2)]
    rows += [(c, t, "user", "> same words\nnew") for c in range(20) for t in (1, 3, 5)]
    got = order(spark, rows)
    assert all((got[c, t].parent_conv, got[c, t].parent_turn) == (c, t - 1) for c in range(20) for t in (1, 3, 5))


def test_long_chain(spark):
    rows = [(1, t, "user", f"message {t}") for t in range(300)]
    got = order(spark, rows)
    assert all((got[1, t].thread_turn, got[1, t].depth) == (0, t) for t in range(300))


def test_awkward_rows(spark):
    rows = [
        (1, 0, None, None), (1, 1, "user", ""), (1, 1, "user", ""), (1, 1, "a", "> \n>"), (None, 1, "user", "> hello"), (2, None, "user", "x"),
        (None, None, None, None), (3, 0, "user", "a\u0001b\u0002\r\n> q\r\n" + "w " * 100_000), (4, 0, "u", "> > >\n>>> deep"),
    ]
    got = quotes.reply_order(frame(spark, rows, TALK)).collect()
    assert len(got) == len(rows)
    assert sorted(str(r.text) for r in got)[0] == "" and all(r.text is not None for r in got)
    assert [r.n_quotes for r in got if r.conv_id in (3, 4)] and all(r.n_quotes == 1 for r in got if r.conv_id in (3, 4))
    assert quotes.reply_order(frame(spark, [], TALK)).collect() == []


def plain_parents(rows):
    """Conversations without quotes: each message follows the turn before it."""
    return {(c, t): ((c, t - 1) if (c, t - 1) in {(a, b) for a, b, *_ in rows} else (None, None)) for c, t, *_ in rows}


def test_sample_conversations(spark, sf_dir):
    from farelens.llm.common import table

    messages = table(spark, sf_dir, "conversations")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in messages.collect()]
    want = plain_parents(rows)
    got = quotes.reply_order(messages).collect()
    assert len(got) == len(rows)
    assert {(r.conv_id, r.turn): (r.parent_conv, r.parent_turn) for r in got} == want


def parts_of(text):
    """(level, body) of each run of lines of one level between blank lines."""
    runs, last = [], None
    for line in re.split("\r\n|\r|\n", text or ""):
        mark = re.match(r"(?:[ \t]*>)+", line)
        level = mark.group().count(">") if mark else 0
        body = re.sub(r"^(?:[ \t]*>)+ ?", "", line)
        if last is not None and last[0] == level and last[1].strip(" ") and body.strip(" "):
            runs[-1][1] += "\n" + body
        else:
            runs.append([level, body])
        last = (level, body)
    return [(level, body) for level, body in runs if body.strip(" ")]


def plain(text):
    return re.sub(r"\s+", " ", text.lower()).strip(" ")


def linker(rows):
    """Parent of each message, by looking through all messages before it."""
    written = {}
    for conv, turn, _, text in rows:
        own = [body for level, body in parts_of(text) if level == 0]
        written[conv, turn] = {plain(b) for b in [*own, "\n\n".join(own)]} - {""}
    parents = {}
    for conv, turn, _, text in rows:
        found = []
        for place, (level, body) in enumerate(p for p in parts_of(text) if p[0] > 0):
            equal = [k for k, bodies in written.items() if plain(body) in bodies]
            near = [t for c, t in equal if c == conv and t < turn]
            first = min(((t, c) for c, t in equal), default=None)
            if near:
                found.append((level, place, conv, max(near)))
            elif first and first < (turn, conv):
                found.append((level, place, first[1], first[0]))
        if found:
            parents[conv, turn] = (*min(found)[2:], "quote")
        elif (conv, turn - 1) in written:
            parents[conv, turn] = (conv, turn - 1, "turn")
        else:
            parents[conv, turn] = (None, None, "start")
    return parents


def test_equals_a_plain_linker_on_random_threads(spark):
    rng = random.Random(11)
    for seed in range(3):
        said, rows = [], []
        for conv in range(12):
            for turn in sorted(rng.sample(range(3000 if seed else 14), 10)):
                lines = []
                for _ in range(rng.randint(0, 2)):
                    if said:
                        quoted = rng.choice(said)
                        deep = rng.randint(1, 3)
                        quoted = quoted.upper() if rng.random() < 0.3 else quoted.replace(" ", rng.choice([" ", "  "]))
                        lines += [rng.choice([">" * deep + " ", "> " * deep]) + part for part in quoted.split("\n")]
                        if rng.random() < 0.5:
                            lines.append("")
                for _ in range(rng.randint(1, 2)):
                    own = " ".join(rng.choice(["yes", "no", "why", "so"]) for _ in range(rng.randint(1, 3)))
                    own += "\n" + rng.choice(["ok", "well"]) if rng.random() < 0.2 else ""
                    said.append(own)
                    lines += [own, ""]
                rows.append((conv, turn, "user", "\n".join(lines)))
        got = {k: (r.parent_conv, r.parent_turn, r.reply) for k, r in order(spark, rows).items()}
        want = linker(rows)
        assert got == want and sum(p[2] == "quote" for p in want.values()) > 40


def test_equal_messages_make_no_pairs(spark):
    """A conversation of equal turns, each quoting the one before: the last before it, in any span."""
    rows = [(1, t, "user", "same" if t % 2 == 0 else "> same\nnew") for t in range(0, 4000)]
    messages = frame(spark, rows, TALK)
    found = quotes.reply_order(messages).where("turn % 2 = 1").selectExpr("count(*)", "count_if(parent_turn = turn - 1)").first()
    assert tuple(found) == (2000, 2000)
    plan = quotes._latest_before(
        spark.createDataFrame([(1, "h", 5, 0, 1)], "conv_id long, hash string, turn long, place int, level int"),
        spark.createDataFrame([(1, "h", 2)], "conv_id long, hash string, turn long"),
    )
    assert [tuple(r) for r in plan.collect()] == [(1, 5, 0, 1, 2)]
