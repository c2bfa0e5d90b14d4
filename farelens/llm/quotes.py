"""Links quoted passages to the messages they come from and orders conversations by reply.

A line's quote level is the number of ``>`` it begins with. Lines of one level that stand together form a
passage. Passages and messages are compared by the hash of their normalised text (lower case, each run
of white space one space, quote marks removed): a passage stands for a message if it equals the whole of
what its author wrote, or one of its paragraphs (lines between blank lines or quotes). A message answers
the message its first linked passage of level 1 stands for; without one, the linked passage of the
lowest level; without any, the turn before it in its conversation; else it begins a thread.

Messages are ordered by turn, then conversation; a quote only ever points to an earlier message, so
threads have no circles. Within its own conversation a passage means the latest equal message before
it, elsewhere the earliest of all: each passage meets two messages at most, however common its text is.

Rows that repeat a conversation and turn all appear in the result; the smallest (role, text) stands for
them when others quote or follow them. Null text is empty, null keys never match. The control characters
U+0001 and U+0002 become spaces. An empty table gives no rows. Extra columns are ignored. DataFrame operations
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelens.session import stage

MARKS = r"^((?:[ \t]*>)+)"
SPAN = 1024  # turns


def _plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``parts``: runs of lines of one level, as (level, text)."""
    lines = F.transform(
        F.split(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), "\r\n?", "\n"), "\n"),
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", "")).alias("level"),
            F.regexp_replace(line, MARKS + "[ ]?", "").alias("body"),
        ),
    )
    numbered = F.transform(
        F.col("lines"),
        lambda x, i: F.struct(
            x["level"].alias("level"),
            x["body"].alias("body"),
            # A blank line ends a passage or paragraph.
            ((i > 0) & (F.get(F.col("lines"), i - 1)["level"] == x["level"]) & (F.trim(x["body"]) != "")
             & (F.trim(F.get(F.col("lines"), i - 1)["body"]) != "")).alias("same"),
        ),
    )
    # Runs are cut out of one string by characters that text is freed of beforehand.
    flat = F.array_join(
        F.transform(
            "numbered",
            lambda x: F.concat(F.when(x["same"], F.lit("\n")).otherwise(F.concat(F.lit("\u0001"), x["level"].cast("string"), F.lit("\u0002"))), x["body"]),
        ),
        "",
    )
    runs = F.transform(
        F.filter(F.split("flat", "\u0001"), lambda run: run != ""),
        lambda run: F.struct(
            F.substring_index(run, "\u0002", 1).cast("int").alias("level"),
            F.substring_index(run, "\u0002", -1).alias("body"),
        ),
    )
    return (
        messages.select("conv_id", "turn", F.col("role").cast("string"), F.translate("text", "\u0001\u0002", "  ").alias("text"))
        .withColumn("lines", lines)
        .withColumn("numbered", numbered)
        .withColumn("flat", flat)
        .withColumn("parts", F.filter(runs, lambda r: F.trim(r["body"]) != ""))
        .drop("lines", "numbered", "flat")
    )


def reply_order(messages: DataFrame) -> DataFrame:
    """Per row: conv_id, turn, role, text (without quotes), n_quotes, n_linked, parent_conv, parent_turn,
    reply ("quote", "turn" or "start"), thread_conv, thread_turn, depth.

    Sorted by (thread_conv, thread_turn, depth, conv_id, turn) every message follows the one it answers.
    """
    own = F.filter("parts", lambda p: p["level"] == 0)
    rows = stage(
        _parsed(messages)
        .withColumn("own", F.transform(own, lambda p: p["body"]))
        .withColumn("quotes", F.filter("parts", lambda p: p["level"] > 0))
        .select("conv_id", "turn", "role", F.array_join("own", "\n\n").alias("text"), "own", "quotes"),
        "quote-rows",
    )
    nodes = stage(
        rows.where("conv_id is not null and turn is not null")
        .groupBy("conv_id", "turn")
        .agg(F.min(F.struct("role", "text", "own", "quotes")).alias("m"))
        .select("conv_id", "turn", "m.text", "m.own", "m.quotes"),
        "quote-nodes",
    )
    texts = (
        nodes.select("conv_id", "turn", F.explode(F.array_distinct(F.concat(F.array("text"), "own"))).alias("body"))
        .select("conv_id", "turn", F.sha2(_plain(F.col("body")), 256).alias("hash"), F.length(_plain(F.col("body"))).alias("n"))
        .where("n > 0")
    )
    passages = nodes.select("conv_id", "turn", F.posexplode("quotes").alias("place", "q")).select(
        "conv_id", "turn", "place", "q.level", F.sha2(_plain(F.col("q.body")), 256).alias("hash")
    )
    passages = stage(passages, "quote-passages")
    quoted = passages.select("hash").distinct()
    nearby = _latest_before(passages, texts.join(quoted, "hash", "left_semi")).withColumn("to_conv", F.col("conv_id"))
    earliest = (
        texts.join(quoted, "hash", "left_semi")
        .groupBy("hash")
        .agg(F.min(F.struct(F.col("turn").alias("t"), F.col("conv_id").alias("c"))).alias("e"))
    )
    elsewhere = (
        passages.join(earliest, "hash")
        .where("e.t < turn or (e.t = turn and e.c < conv_id)")
        .select("conv_id", "turn", "place", "level", F.col("e.t").alias("far_turn"), F.col("e.c").alias("far_conv"))
    )
    linked = nearby.join(elsewhere, ["conv_id", "turn", "place", "level"], "full").select(
        "conv_id",
        "turn",
        "place",
        "level",
        F.coalesce("to_turn", "far_turn").alias("to_turn"),
        F.when(F.col("to_turn").isNotNull(), F.col("conv_id")).otherwise(F.col("far_conv")).alias("to_conv"),
    )
    answers = linked.groupBy("conv_id", "turn").agg(
        F.min(F.struct("level", "place", "to_conv", "to_turn")).alias("a"), F.count("*").alias("n_linked")
    )
    before = nodes.select("conv_id", (F.col("turn") + 1).alias("turn"), F.lit(True).alias("follows"))
    parents = (
        nodes.select("conv_id", "turn")
        .join(answers, ["conv_id", "turn"], "left")
        .join(before, ["conv_id", "turn"], "left")
        .select(
            "conv_id",
            "turn",
            F.coalesce("a.to_conv", F.when(F.col("follows"), F.col("conv_id"))).alias("parent_conv"),
            F.coalesce("a.to_turn", F.when(F.col("follows"), F.col("turn") - 1)).alias("parent_turn"),
            F.when(F.col("a").isNotNull(), "quote").when(F.col("follows"), "turn").otherwise("start").alias("reply"),
            F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        )
    )
    threads = _threads(stage(parents, "quote-parents"))
    return rows.join(threads, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.size("quotes").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        "parent_conv",
        "parent_turn",
        F.coalesce("reply", F.lit("start")).alias("reply"),
        F.coalesce("thread_conv", "conv_id").alias("thread_conv"),
        F.coalesce("thread_turn", "turn").alias("thread_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
    )


def _latest_before(passages: DataFrame, texts: DataFrame, span: int = SPAN) -> DataFrame:
    """conv_id, turn, place, level and to_turn: the last equal message of the conversation before the passage.

    Passages and messages of one conversation and hash stand in one order of turns, where a passage sees the
    last message before it; no pairs are made. Turns are cut in spans, so that a conversation of very many
    equal messages is many groups; what a span has not seen itself comes from the spans before it.
    """
    own = texts.selectExpr("conv_id", "hash", "turn", "CAST(NULL AS INT) place", "CAST(NULL AS INT) level", "turn near")
    events = passages.selectExpr("conv_id", "hash", "turn", "place", "level", "CAST(NULL AS BIGINT) near").unionByName(own)
    events = events.withColumn("span", F.floor(F.col("turn") / span))
    # A passage comes before the messages of its own turn.
    inside = Window.partitionBy("conv_id", "hash", "span").orderBy("turn", F.col("near").isNotNull())
    seen = events.withColumn("seen", F.last("near", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    spans = events.groupBy("conv_id", "hash", "span").agg(F.max("near").alias("top"))
    before = Window.partitionBy("conv_id", "hash").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("earlier", F.last("top", ignorenulls=True).over(before))
    return (
        seen.where("place IS NOT NULL")
        .join(spans, ["conv_id", "hash", "span"])
        .select("conv_id", "turn", "place", "level", F.coalesce("seen", "earlier").alias("to_turn"))
        .where("to_turn IS NOT NULL")
    )


def _threads(parents: DataFrame) -> DataFrame:
    """Adds each message's thread (its first ancestor) and depth; ancestors are reached by doubling steps.

    A message that has reached its thread's beginning takes no part in further steps.
    """
    state = parents.select(
        "*",
        F.coalesce("parent_conv", "conv_id").alias("thread_conv"),
        F.coalesce("parent_turn", "turn").alias("thread_turn"),
        F.when(F.col("parent_conv").isNull(), 0).otherwise(1).cast("long").alias("depth"),
        F.col("parent_conv").isNotNull().alias("open"),
    )
    while not state.where("open").isEmpty():
        ahead = state.where("depth > 0").selectExpr(
            "conv_id thread_conv", "turn thread_turn", "thread_conv next_conv", "thread_turn next_turn", "depth more"
        )
        moved = (
            state.where("open")
            .join(ahead, ["thread_conv", "thread_turn"], "left")
            .select(
                *parents.columns,
                F.coalesce("next_conv", "thread_conv").alias("thread_conv"),
                F.coalesce("next_turn", "thread_turn").alias("thread_turn"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("more").isNotNull().alias("open"),
            )
        )
        state = stage(state.where("not open").unionByName(moved), "quote-threads")
    return state.drop("open")
