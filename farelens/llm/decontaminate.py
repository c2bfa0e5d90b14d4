"""Finds documents that hold benchmark items, whole and with small edits.

An item is cut into windows of about ``window`` characters. A window of m characters may differ in
k = floor(rate * m) edits; split into k + 1 pieces, at least one piece must occur unchanged in any text
within k edits of it (pigeonhole). All pieces are searched at once in each whole text; around a hit,
Myers' bit-parallel algorithm gives the smallest edit distance of the window to any stretch of the text.
A document is contaminated if a window of an item is within its budget.

Texts are compared in lower case with each run of white space as one space. Windows of fewer than
``least`` characters must equal the text's words exactly (as whole words); items without words match
nothing. Null texts and items count as empty. The benchmark is the query set: it is taken in blocks of
at most ``block`` items, each sent to the tasks after its size is checked, so it may grow without bound.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import chunks, ship, without
from farelens.session import stage

BLOCK_CHARS = 4 << 20


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def windows_of(text: str, window: int) -> list[str]:
    """Cuts at spaces into pieces of equal size, about ``window`` characters; short texts stay whole."""
    parts = max(1, round(len(text) / window))
    out, at = [], 0
    for i in range(parts):
        end = len(text) if i == parts - 1 else max(text.rfind(" ", at + 1, (i + 1) * len(text) // parts), at)
        if end > at:
            out.append(text[at:end].strip())
        at = end
    return [x for x in out if x]


class Pattern:
    """A window: its budget, its pieces and Myers' masks."""

    def __init__(self, item, text: str, rate: float):
        self.item, self.text, self.budget = item, text, int(rate * len(text))
        self.masks: dict[str, int] = defaultdict(int)
        for i, c in enumerate(text):
            self.masks[c] |= 1 << i

    def pieces(self) -> list[tuple[str, int]]:
        n, m = self.budget + 1, len(self.text)
        cuts = [i * m // n for i in range(n + 1)]
        return [(self.text[a:b], a) for a, b in zip(cuts, cuts[1:], strict=False)]

    def distance(self, text: str) -> int:
        """Smallest edit distance of the window to any stretch of ``text``."""
        m, masks = len(self.text), self.masks
        full, top = (1 << m) - 1, 1 << (m - 1)
        plus, minus, score = full, 0, m
        best = m
        for c in text:
            eq = masks.get(c, 0)
            diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
            up = minus | (full & ~(diagonal | plus))
            down = plus & diagonal
            if up & top:
                score += 1
            elif down & top:
                score -= 1
                if score < best:
                    best = score
            up = (up << 1) & full
            down = (down << 1) & full
            plus = down | (full & ~((diagonal | minus) | up))
            minus = up & (diagonal | minus)
        return best


class Searcher:
    """All windows of a block of items, ready to search texts."""

    def __init__(self, items: list[tuple], rate: float, window: int, least: int):
        import ahocorasick

        self.least = least
        self.patterns = [
            Pattern(item, w, rate if len(w) >= least else 0.0)
            for item, text in items
            for w in windows_of(normalised(text), window)
        ]
        places = defaultdict(list)
        for n, p in enumerate(self.patterns):
            for piece, at in p.pieces():
                places[piece].append((n, at))
        self.tree = ahocorasick.Automaton()
        for piece, where in places.items():
            where.sort(key=lambda x: (x[0], -x[1]))  # the earliest alignment first: its stretch reaches over most others
            self.tree.add_word(piece, (len(piece), where))
        self.tree.make_automaton()

    def search(self, text: str) -> dict:
        """Item ids found in a normalised text, each with the smallest distance of its windows."""
        found: dict = {}
        done: dict[int, tuple[int, int]] = {}  # alignments, first to last, that lie inside checked stretches
        exact: set[int] = set()
        for end, (size, where) in self.tree.iter(text):
            start = end + 1 - size
            for n, at in where:
                if n in exact:
                    continue
                p = self.patterns[n]
                low = start - at
                if len(p.text) < self.least:
                    whole = (not low or text[low - 1] == " ") and text[low + len(p.text) : low + len(p.text) + 1] in ("", " ")
                    distance = 0 if whole else None
                elif text.startswith(p.text, max(low, 0)) and low >= 0:
                    distance = 0
                elif n in done and done[n][0] <= low <= done[n][1]:
                    continue
                else:
                    # A stretch a little longer than the window, so that hits close by share one check.
                    high = low + 2 * len(p.text) + p.budget
                    distance = p.distance(text[max(0, low - p.budget) : high])
                    first, last = low if low > p.budget else -len(p.text), high - len(p.text) - 2 * p.budget
                    if n in done and first <= done[n][1] + 1 and done[n][0] <= last + 1:
                        first, last = min(first, done[n][0]), max(last, done[n][1])
                    done[n] = first, last
                    if distance > p.budget:
                        distance = None
                if distance is not None:
                    found[p.item] = min(found.get(p.item, distance), distance)
                    if not distance:
                        exact.add(n)
        return found


def _blocks(benchmark: DataFrame, block: int):
    """The benchmark's rows, at most ``block`` items and a few MB of text at a time."""
    rows = benchmark.select("item_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    total = rows.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).first()
    parts = max(1, -(-total["n"] // block), -(-(total["chars"] or 0) // BLOCK_CHARS))
    if parts > 1:
        rows = stage(rows, "benchmark")
    for part in range(parts):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) if parts > 1 else rows
        yield sorted((tuple(r) for r in own.collect()), key=str)


def find_contaminated(
    docs: DataFrame, benchmark: DataFrame, rate: float = 0.07, window: int = 240, least: int = 30, block: int = 2000
) -> DataFrame:
    """Per document: doc_id, contaminated, n_items, item_ids (ascending), min_distance (null if clean)."""
    spark = docs.sparkSession
    ship(spark)
    item = benchmark.schema["item_id"].dataType.simpleString()
    doc = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    results = []
    for items in _blocks(benchmark, block):
        sent = spark.sparkContext.broadcast(items)

        def search(batches, sent=sent):
            searcher = Searcher(sent.value, rate, window, least)
            for batch, _, _ in chunks(batches):
                found = (
                    [searcher.search(normalised(t)) for t in batch.column("text").to_pylist()]
                    if searcher.patterns
                    else [{}] * batch.num_rows
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array([list(x) for x in found], pa.list_(ITEM_TYPES[item])),
                        pa.array([min(x.values(), default=None) for x in found], pa.int32()),
                    ],
                    ["doc_id", "item_ids", "min_distance"],
                )

        results.append(texts.mapInArrow(search, f"doc_id {doc}, item_ids array<{item}>, min_distance int"))
    found = results[0]
    if len(results) > 1:
        # Only hits of the later blocks move; the first block's rows carry the documents.
        for more in results[1:]:
            found = found.unionByName(more.where("min_distance is not null"))
        found = found.groupBy("doc_id").agg(
            F.flatten(F.collect_list("item_ids")).alias("item_ids"), F.min("min_distance").alias("min_distance")
        )
    return found.select(
        "doc_id",
        F.col("min_distance").isNotNull().alias("contaminated"),
        F.size("item_ids").alias("n_items"),
        F.sort_array("item_ids").alias("item_ids"),
        "min_distance",
    )


ITEM_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """``docs`` with all its columns, without the documents that hold a benchmark item."""
    # By text: ids may be null or stand on several texts.
    sha = F.sha2(F.coalesce("text", F.lit("")), 256)
    found = stage(find_contaminated(docs.select(sha.alias("doc_id"), "text"), benchmark, **settings), "contaminated")
    return without(docs, sha, found.where("contaminated").select("doc_id"))
