"""Document quality by a factorisation machine over hashed words, text structure and metadata.

score = sigmoid(b + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)): pairwise interactions
of low rank, in time linear in a document's words. Words are hashed into ``BUCKETS`` columns, their
counts scaled to length 1 (less in short texts); structure columns are shares and logarithms of counts of the text; the
metadata column is the declared ``n_chars`` (the text's own length where it is missing or null).

The model is fitted on a bounded sample of labelled rows (``max_train``, by hash of the id) outside the
test part and is applied to every whole text. Null text counts as empty and is scored like any other.
Without labelled rows of both kinds every document scores the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import Words, chunks, ship, without
from farelens.llm.labelled import held_out, training_rows
from farelens.session import stage

BUCKETS = 1 << 16
RANK = 4
STATS = 15
SMOOTH = 100.0  # keeps the few words of a short text from deciding alone
_KIND = np.zeros(256, np.uint8)  # 1 lower, 2 upper, 3 digit, 4 sentence mark, 5 other ASCII sign, 6 line end, 7 beyond ASCII
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 1, 2, 3
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 5
_KIND[[ord(c) for c in ".,;:'\"()-?"]] = 4
_KIND[10], _KIND[128:] = 6, 7


def features(data: np.ndarray, offsets: np.ndarray, declared: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its feature numbers and values; structure columns follow the word buckets."""
    words = Words(data, offsets)
    last = _KIND[words.data[words.end - 1]] if len(words.end) else np.zeros(0, np.uint8)
    length = words.end - words.start
    bucket = (words.hash >> np.uint64(48)).astype(np.int64)
    for i in range(len(offsets) - 1):
        text = data[offsets[i] : offsets[i + 1]]
        a, b = words.bounds[i], words.bounds[i + 1]
        ids, counts = np.unique(bucket[a:b], return_counts=True)
        kinds = np.bincount(_KIND[text], minlength=8)
        size, n, n_lines = max(len(text), 1), max(b - a, 1), kinds[6] + 1
        own = np.log1p(len(text) if declared[i] is None else max(declared[i], 0))
        stats = np.array(
            [
                np.log1p(len(text)) / 10, np.log1p(b - a) / 8, own / 10, np.log1p(n_lines) / 6,
                kinds[2] / size * 4, kinds[3] / size * 8, kinds[4] / size * 8, kinds[5] / size * 8,
                kinds[7] / size * 4, len(ids) / n, length[a:b].mean() / 8 if b > a else 0.0,
                (last[a:b] == 5).mean() * 2 if b > a else 0.0, (length[a:b] == 1).mean() * 2 if b > a else 0.0,
                np.log1p(n / n_lines) / 4, 1.0 if b == a else 0.0,
            ]
        )
        values = counts / np.sqrt((counts.astype(float) ** 2).sum() + SMOOTH)
        yield np.concatenate([ids, np.arange(BUCKETS, BUCKETS + STATS)]), np.concatenate([values, stats])


class FactorisationMachine:
    def __init__(self, seed: int = 3):
        rng = np.random.RandomState(seed)
        self.bias = 0.0
        self.w = np.zeros(BUCKETS + STATS)
        self.v = rng.normal(0, 0.02, (BUCKETS + STATS, RANK))

    def raw(self, ids: np.ndarray, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid, and each document's sums over v_if x_i; every document has features."""
        vx = self.v[ids] * x[:, None]
        sums = np.add.reduceat(vx, starts)
        return (
            self.bias
            + np.add.reduceat(self.w[ids] * x, starts)
            + 0.5 * (sums**2 - np.add.reduceat(vx**2, starts)).sum(1),
            sums,
        )

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int, rate: float = 0.1) -> None:
        """Adagrad on the logistic loss."""
        share = y.mean()
        self.bias = float(np.log(share / (1 - share)))
        seen_w, seen_v, seen_b = np.full_like(self.w, 1e-6), np.full_like(self.v, 1e-6), 1e-6
        rng = np.random.RandomState(11)
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), 128):
                part = order[at : at + 128]
                ids = np.concatenate([rows[i][0] for i in part])
                x = np.concatenate([rows[i][1] for i in part])
                sizes = np.array([len(rows[i][0]) for i in part])
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                raw, sums = self.raw(ids, x, starts)
                error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[part]) / len(part)
                each = np.repeat(error, sizes) * x
                used, place = np.unique(ids, return_inverse=True)
                g_w = np.bincount(place, each) + 1e-6 * self.w[used]
                step = each[:, None] * (np.repeat(sums, sizes, 0) - self.v[ids] * x[:, None])
                g_v = np.stack([np.bincount(place, step[:, f]) for f in range(RANK)], 1) + 1e-5 * self.v[used]
                seen_w[used] += g_w**2
                seen_v[used] += g_v**2
                self.w[used] -= rate * g_w / np.sqrt(seen_w[used])
                self.v[used] -= 0.3 * rate * g_v / np.sqrt(seen_v[used])
                seen_b += error.sum() ** 2
                self.bias -= rate * error.sum() / np.sqrt(seen_b)


def _prepared(docs: DataFrame) -> DataFrame:
    declared = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), declared.alias("declared"))


def train(docs: DataFrame, labels: DataFrame, label: str, parts: int, rest: int, max_train: int, epochs: int):
    """The fitted model, or the score of every document if the labels don't allow fitting one."""

    def extract(batches):
        for batch, data, offsets in chunks(batches):
            found = list(features(data, offsets, batch.column("declared").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0].astype(np.int32).tobytes() for x in found], pa.binary()),
                    pa.array([x[1].astype(np.float32).tobytes() for x in found], pa.binary()),
                    batch.column("y").cast(pa.int32()),
                ],
                ["ids", "x", "y"],
            )

    sample = training_rows(_prepared(docs), labels, label, parts, rest, max_train)
    got = sorted(sample.mapInArrow(extract, "ids binary, x binary, y int").collect())  # max_train rows at most
    y = np.array([r["y"] for r in got], float)
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    model = FactorisationMachine()
    model.fit([(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["x"], np.float32).astype(float)) for r in got], y, epochs)
    return model


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    parts: int = 4,
    rest: int = 2,
    max_train: int = 6000,
    epochs: int = 6,
    threshold: float = 0.7,
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    ship(docs.sparkSession)
    model = train(docs, labels, label, parts, rest, max_train, epochs)
    return _scored(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id"), parts, rest).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def _scored(docs: DataFrame, fitted) -> DataFrame:
    """doc_id and score of every row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(fitted)

    def score(batches):
        fitted = model.value
        for batch, data, offsets in chunks(batches):
            if isinstance(fitted, float):
                value = np.full(batch.num_rows, fitted)
            else:
                rows = list(features(data, offsets, batch.column("declared").to_pylist()))
                starts = np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])[:-1]]).astype(np.int64)
                raw, _ = fitted.raw(np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), starts)
                value = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(value)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _prepared(docs).mapInArrow(score, f"doc_id {kind}, score double")


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    parts: int = 4,
    rest: int = 2,
    max_train: int = 6000,
    epochs: int = 6,
    threshold: float = 0.7,
) -> DataFrame:
    """``docs`` with all its columns, without the documents that the classifier rejects.

    A score depends on nothing but the text and its declared length, so these name what goes: a row with a null
    id, or with an id that other texts have too, is judged like any other.
    """
    ship(docs.sparkSession)
    fitted = train(docs, labels, label, parts, rest, max_train, epochs)
    declared = F.col("n_chars").cast("long").cast("string") if "n_chars" in docs.columns else F.lit(None).cast("string")
    judged = F.sha2(F.concat(F.coalesce(declared, F.lit("")), F.lit(" "), F.coalesce("text", F.lit(""))), 256)
    named = docs.select(judged.alias("doc_id"), "text", *[c for c in ("n_chars",) if c in docs.columns])
    scored = stage(_scored(named, fitted), "quality")
    return without(docs, judged, scored.where(F.col("score") < threshold).select("doc_id"))
