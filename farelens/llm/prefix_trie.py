"""Prefix trie of conversations from vertical bitmaps.

Every distinct sequence of first turns (role, text) is a node; the conversations that start with it are its
members. Conversations are sorted by their turns' digests, an end after all turns, and dealt in ranges, so a
node's members are neighbours and a prefix that a third of all conversations share is spread over many tasks.
A task walks its range in shards of at most ``SHARD`` conversations:

1. An index maps (position, turn) to the bitset of the shard's conversations that hold this turn there, and
   each length to the bitset of those that end there.
2. Depth first from the root, a node's bitset is intersected with the postings of its members' next turns:
   one intersection yields one child, its popcount the members, the intersection with the length's bitset
   the node's end list. Sums over subtrees are added up on the way back.

A node whose members lie in several shards is owned by the first of them, known from the conversation that
stands before a shard: only the owner counts the node as a child, a leaf and a text. So all figures of such
nodes, at most two paths a shard, add up in one small aggregation; all other nodes are finished where they
are found. The conversations that end at one node follow each other by id, so that its end list is the
shards' lists one after the other, hashed in a stream.

Turns stand by number, null first, then by role and the text's digest. Null role and text are empty. Rows
without conv_id are ignored, repeated rows are turns of their own, other columns are ignored. An empty table
gives no node, not even the root. Turns are compared by 128-bit digests; a conversation's digests and
lengths, 20 bytes a turn, are one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelens.llm.common import ship
from farelens.session import stage

SHARD = 2048
SHARD_TURNS = 200_000
PART_TURNS = 1 << 15
MOST_PARTS = 10_000
NUMBER_BLOCK = 1024
DIGEST = 16

FOUND = pa.schema(
    [
        ("open", pa.bool_()),
        ("key", pa.binary()),
        ("parent_key", pa.binary()),
        ("part", pa.int32()),
        ("shard", pa.int32()),
        ("conv_id", pa.int64()),
        ("depth", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("ends", pa.string()),
    ]
)
_SQL_TYPES = {pa.bool_(): "boolean", pa.binary(): "binary", pa.int32(): "int", pa.int64(): "long", pa.string(): "string"}
FOUND_SQL = ", ".join(f"{f.name} {_SQL_TYPES[f.type]}" for f in FOUND)


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, pos, digest, chars); pos counts a conversation's turns from 0.

    Turns are numbered in blocks of turn numbers first and the blocks' counts added up, so that a very long
    conversation isn't sorted by one task.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.length(text).alias("chars"),
        F.floor(F.col("turn") / NUMBER_BLOCK).alias("block"),
    )
    before = Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    starts = starts.select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    return (
        rows.withColumn("nth", F.row_number().over(inside))
        .join(starts, (F.col("conv_id") == F.col("c")) & F.col("block").eqNullSafe(F.col("b")))
        .select("conv_id", (F.col("start") + F.col("nth") - 1).alias("pos"), "digest", "chars")
    )


def whole(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and its turns' digests and chars as arrays, from rows in order."""
    turn = F.struct("pos", "digest", "chars")
    listed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return listed.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.chars").alias("chars"))


def regrown(turns: DataFrame, family: int = 100, longest: int = 5) -> DataFrame:
    """Conversations rebuilt on the family's first one, as ``whole`` gives them.

    Conversation c takes the first h turns of c - c % ``family`` (none if that doesn't exist) and its own
    turns after its first h; h is the unsigned crc32 of c in decimal modulo ``longest`` + 1.
    """
    own = whole(turns)
    base = F.col("conv_id") - F.col("conv_id") % family
    heads = turns.where((F.col("conv_id") % family == 0) & (F.col("pos") < longest))
    heads = whole(heads).select(F.col("conv_id").alias("base"), F.col("digests").alias("d"), F.col("chars").alias("c"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)).cast("int")
    joined = own.withColumns({"base": base, "h": h}).join(heads, "base", "left")

    def rebuilt(head: str, tail: str):
        kept = F.when(F.col(head).isNull(), F.slice(tail, 1, F.lit(0))).otherwise(F.slice(head, F.lit(1), F.col("h")))
        return F.concat(kept, F.slice(tail, F.col("h") + 1, F.size(tail))).alias(tail)

    return joined.select("conv_id", rebuilt("d", "digests"), rebuilt("c", "chars"))


# --- one shard -----------------------------------------------------------------------------------


def _common(one: bytes, other: bytes) -> int:
    """Turns that two keys share from the start; a key's last digest is the mark of its end."""
    most = min(len(one), len(other)) // DIGEST - 1
    a, b = (np.frombuffer(key, np.uint64, most * 2).reshape(-1, 2) for key in (one, other))
    apart = (a != b).any(axis=1)
    return int(apart.argmax()) if apart.any() else most


def _path_keys(key: bytes, most: int) -> list[bytes]:
    """Names of the nodes on a path, root first, down to depth ``most``."""
    digest = hashlib.md5()
    names = [digest.digest()]
    for at in range(0, most * DIGEST, DIGEST):
        digest.update(key[at : at + DIGEST])
        names.append(digest.copy().digest())
    return names


def _members(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def shard_nodes(ids: list[int], keys: list[bytes], chars: list, before: bytes | None, after: bytes | None) -> Iterator[dict]:
    """Nodes of the trie of some sorted conversations, between the conversations ``before`` and ``after``.

    ``after`` None: not known, so every node of the last path may go on.
    """
    lengths = [len(key) // DIGEST - 1 for key in keys]
    postings: dict[tuple[int, bytes], int] = {}
    ending: dict[int, int] = {}
    for i, (key, length) in enumerate(zip(keys, lengths)):
        bit = 1 << i
        ending[length] = ending.get(length, 0) | bit
        for pos in range(length):
            turn = (pos, key[pos * DIGEST : pos * DIGEST + DIGEST])
            postings[turn] = postings.get(turn, 0) | bit
    seen = -1 if before is None else _common(before, keys[0])  # nodes of the first path that aren't this shard's own
    going = lengths[-1] if after is None else _common(keys[-1], after)
    first_names, last_names = _path_keys(keys[0], seen), _path_keys(keys[-1], going)
    last = 1 << len(keys) - 1

    nodes = []  # parents before children: bits, depth, parent, own, chars
    stack = [((1 << len(keys)) - 1, 0, -1)]
    while stack:
        bits, depth, parent = stack.pop()
        first = (bits & -bits).bit_length() - 1
        at = len(nodes)
        own = not (bits & 1 and depth <= seen)
        length = chars[first][depth - 1] if depth else 0
        ends = bits & ending.get(depth, 0)
        nodes.append([bits, depth, parent, own, length, ends])
        rest = bits ^ ends
        while rest:
            i = (rest & -rest).bit_length() - 1
            child = bits & postings[(depth, keys[i][depth * DIGEST : depth * DIGEST + DIGEST])]
            stack.append((child, depth + 1, at))
            rest &= ~child

    count = len(nodes)
    least, children, leaves, shared, distinct = ([0] * count for _ in range(5))
    least = [None] * count
    for at in range(count - 1, -1, -1):
        bits, depth, parent, own, length, ends = nodes[at]
        if ends:
            lowest = ids[(ends & -ends).bit_length() - 1]
            least[at] = lowest if least[at] is None else min(least[at], lowest)
        if own and ends == bits:
            leaves[at] += 1
        shared[at] += bits.bit_count() * length
        distinct[at] += length if own else 0
        if parent >= 0:
            least[parent] = least[at] if least[parent] is None else min(least[parent], least[at])
            children[parent] += own
            leaves[parent] += leaves[at]
            shared[parent] += shared[at]
            distinct[parent] += distinct[at]

    def name(at: int) -> bytes | None:
        """The node's name if other shards may hold members of it."""
        bits, depth = nodes[at][:2]
        if bits & 1 and depth <= seen:
            return first_names[depth]
        return last_names[depth] if bits & last and depth <= going else None

    names = [name(at) for at in range(count)]
    for at, (bits, depth, parent, _, _, ends) in enumerate(nodes):
        inner = parent >= 0 and names[parent] is None
        yield {
            "open": names[at] is not None,
            "key": names[at],
            "parent_key": names[parent] if parent >= 0 else None,
            "conv_id": least[at],
            "depth": depth,
            "parent_conv_id": least[parent] if inner else None,
            "n_convs": bits.bit_count(),
            "n_children": children[at],
            "n_leaves": leaves[at],
            "saved_tokens": shared[at] - distinct[at],
            "ends": ",".join(str(ids[i]) for i in _members(ends)),
        }


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(name).to_pylist() for name in ("part", "conv_id", "key", "chars")])


def _walk(batches: Iterable[pa.RecordBatch], shard: int, shard_turns: int) -> Iterator[pa.RecordBatch]:
    """Cuts sorted conversations in shards. A part's first row, without id, is the key that stands before it."""
    held: list[tuple] = []
    part, before, number, turns = None, None, 0, 0

    def flush(after: bytes | None) -> Iterator[pa.RecordBatch]:
        nonlocal held, before, number, turns
        if held:
            ids, keys, chars = (list(column) for column in zip(*held))
            found = [{**node, "part": part, "shard": number} for node in shard_nodes(ids, keys, chars, before, after)]
            for node in found:
                if not node["open"]:
                    node["ends"] = hashlib.sha256(node["ends"].encode()).hexdigest()
            for at in range(0, len(found), 10_000):
                yield pa.RecordBatch.from_pylist(found[at : at + 10_000], FOUND)
            before, number = keys[-1], number + 1
            held, turns = [], 0

    for own_part, conv_id, key, chars in _conversations(batches):
        if own_part != part:
            yield from flush(None)
            part, before, number = own_part, None, 0
        if conv_id is None:
            before = key
            continue
        if len(held) == shard or turns >= shard_turns:
            yield from flush(key)
        held.append((conv_id, key, chars))
        turns += len(chars)
    yield from flush(None)


def _hash_ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per key of end lists that follow each other."""
    key, digest, done = None, None, []
    for batch in batches:
        for own, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if own != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = own, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ends.encode())
        if len(done) > 1000:
            yield _hashed(done)
            done = []
    if key is not None:
        done.append((key, digest.hexdigest()))
    yield _hashed(done)


def _hashed(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([key for key, _ in rows], pa.binary()), pa.array([sha for _, sha in rows], pa.string())], ["key", "sha"]
    )


# --- the whole trie ------------------------------------------------------------------------------


def prefix_trie(conversations: DataFrame, shard: int = SHARD, shard_turns: int = SHARD_TURNS, part_turns: int = PART_TURNS) -> DataFrame:
    """Nodes of the trie of ``conversations`` as ``whole`` gives them.

    Columns: conv_id (smallest member, which with depth names the node's text), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens (code points that sharing the node's subtree saves), ends_sha256.
    """
    spark = conversations.sparkSession
    ship(spark)
    key = F.unhex(F.concat(F.array_join("digests", ""), F.lit("FF" * DIGEST)))
    rows = stage(conversations.select("conv_id", key.alias("key"), "chars"), "trie-conversations")
    turns = rows.agg(F.sum(F.size("chars") + 1)).first()[0] or 0
    parts = min(max(-(-turns // part_turns), 1), MOST_PARTS)
    dealt = rows.repartitionByRange(parts, "key", "conv_id").withColumn("part", F.spark_partition_id())
    dealt = stage(dealt.select("part", "conv_id", "key", "chars"), "trie-parts")
    # One row a part: the last key of the part before.
    lasts = dealt.groupBy("part").agg(F.max("key").alias("key"))
    lasts = lasts.withColumn("key", F.lag("key").over(Window.orderBy("part"))).where("key IS NOT NULL")
    marks = lasts.select("part", F.lit(None).cast("long").alias("conv_id"), "key", F.array().cast("array<int>").alias("chars"))
    sorted_rows = (
        dealt.unionByName(marks)
        .repartition(parts, "part")
        .sortWithinPartitions("part", F.col("conv_id").isNotNull(), "key", "conv_id")
    )
    found = stage(sorted_rows.mapInArrow(lambda batches: _walk(batches, shard, shard_turns), FOUND_SQL), "trie-nodes")

    figures = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    several = found.where("open")
    lists = several.where("ends <> ''").select("key", "part", "shard", "ends")
    lists = lists.repartition("key").sortWithinPartitions("key", "part", "shard").mapInArrow(_hash_ends, "key binary, sha string")
    merged = several.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"),
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        *[F.sum(name).alias(name) for name in figures],
    )
    nothing = hashlib.sha256(b"").hexdigest()
    merged = stage(merged.join(lists, "key", "left").withColumn("ends", F.coalesce("sha", F.lit(nothing))), "trie-open")
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", *figures, F.col("ends").alias("ends_sha256")]
    closed = found.where("not open")
    known = closed.where("parent_key IS NULL")
    below = closed.where("parent_key IS NOT NULL").drop("parent_conv_id").join(parents, "parent_key")
    return (
        known.select(*columns)
        .unionByName(below.select(*columns))
        .unionByName(merged.join(parents, "parent_key", "left").select(*columns))
    )
