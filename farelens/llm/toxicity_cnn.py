"""Toxicity by a convolutional network over hashed word embeddings, trained here in numpy.

A word's embedding is the sum of three hashed ones: of the word and of its first 4 and 6 bytes, which
speak for words not seen in training. Filters of several widths slide over a text's words, the
largest answer of each filter enters a logistic layer. Because a filter's answer is a sum over its
positions of (embedding x filter column), one look-up table per position scores whole texts of any
length in linear time. The first axis of the embeddings starts from each word's log-odds among the
training documents, the others at random.

Thresholds are calibrated by language on a part of the training sample: each language's best threshold
is moved to 0.7 by a monotone map of the score. The language is told from the text's own function
words; the ``lang`` column is not read. Fitted on a bounded sample (``max_train``); every whole text is
scored, empty and null ones too. Without labels of both kinds all documents score their share of ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import Words, chunks, ship
from farelens.llm.labelled import held_out, training_rows

BUCKETS = 1 << 15
BEGINNINGS = (1 << 20, 4, 6)  # bytes of a word that each of its embeddings stands for
PAD = BUCKETS * len(BEGINNINGS)
WIDTHS = (1, 2, 3)
FILTERS = 8
DIM = 8
CUT = 0.7
# Frequent function words of the four languages.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for was on are with as be this by from they at",
    "de": "der die und das ist von den mit zu sich nicht ein eine auf dem für im auch als es",
    "fr": "le les et des un une est que qui dans pour pas du sur au par avec ce il plus",
    "es": "el los del las y en por con una su para es al lo como más pero sus ya o",
}
LANGUAGES = [*FUNCTION_WORDS, "other"]


def _function_hashes() -> list[np.ndarray]:
    out = []
    for listed in FUNCTION_WORDS.values():
        data = np.frombuffer(listed.encode(), np.uint8)
        out.append(np.sort(Words(data, np.array([0, len(data)])).hash))
    return out


def tokens(data: np.ndarray, offsets: np.ndarray, known: list[np.ndarray]) -> list[tuple[np.ndarray, int]]:
    """For each text a row of buckets per word, pads at its end, and its language's number.

    A word ends where letters and digits end, so punctuation beside it doesn't change it.
    """
    shown = data.copy()
    shown[_SIGN[shown]] = 32
    words = Words(shown, offsets)
    bucket = np.stack(
        [(words.beginnings(size) >> np.uint64(49)).astype(np.int32) + k * BUCKETS for k, size in enumerate(BEGINNINGS)], 1
    )
    hits = []
    for one in known:
        hits.append(np.concatenate([[0], np.cumsum(one[np.searchsorted(one, words.hash).clip(max=len(one) - 1)] == words.hash)]))
    out = []
    for i in range(len(offsets) - 1):
        a, b = words.bounds[i], words.bounds[i + 1]
        counts = [h[b] - h[a] for h in hits]
        lang = int(np.argmax(counts)) if max(counts) else len(LANGUAGES) - 1
        pads = np.full((max(WIDTHS) - (b > a), len(BEGINNINGS)), PAD, np.int32)
        out.append((np.concatenate([bucket[a:b], pads]), lang))
    return out


_SIGN = np.zeros(256, bool)
_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


class TextCnn:
    def __init__(self, seed: int = 5):
        rng = np.random.RandomState(seed)
        self.e = rng.normal(0, 0.1, (PAD + 1, DIM))
        self.e[PAD] = 0
        self.f = {w: rng.normal(0, 0.3, (w, DIM, FILTERS)) for w in WIDTHS}
        for w in WIDTHS:
            self.f[w][:, 0, : FILTERS // 2] = np.abs(self.f[w][:, 0, : FILTERS // 2]) + 0.3
        self.fb = {w: np.zeros(FILTERS) for w in WIDTHS}
        self.out = np.full(len(WIDTHS) * FILTERS, 0.1)
        self.bias = 0.0
        self.cuts = np.full(len(LANGUAGES), 0.5)

    def tables(self) -> dict:
        return {(w, j): (self.e @ self.f[w][j]).astype(np.float32) for w in WIDTHS for j in range(w)}

    def pooled(self, texts: list[np.ndarray], tables: dict, places: bool = False):
        """Each text's largest answer of every filter and, if asked for, where it stands."""
        ids = np.concatenate(texts)
        sizes = np.array([len(t) for t in texts])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        values, where = [], []
        for w in WIDTHS:
            answer = sum(tables[w, 0][ids[:, k]] for k in range(len(BEGINNINGS)))
            for j in range(1, w):
                for k in range(len(BEGINNINGS)):
                    answer[:-j] += tables[w, j][ids[j:, k]]
            # A window may not begin in the last w - 1 pads, where it would reach the next text.
            for j in range(1, w):
                answer[starts + sizes - j] = -1e9
            top = np.maximum.reduceat(answer, starts)
            values.append(top + self.fb[w])
            if places:
                hit = answer == np.repeat(top, sizes, 0)
                at = np.full(top.shape, -1, np.int64)
                doc = np.repeat(np.arange(len(texts)), sizes)
                for f in range(FILTERS):
                    pos = np.flatnonzero(hit[:, f])
                    at[doc[pos][::-1], f] = pos[::-1]
                where.append(at)
        return np.concatenate(values, 1), ids, where

    def probability(self, texts: list[np.ndarray], tables: dict) -> np.ndarray:
        top, _, _ = self.pooled(texts, tables)
        return 1 / (1 + np.exp(-np.clip(np.maximum(top, 0) @ self.out + self.bias, -30, 30)))

    def fit(self, texts: list[np.ndarray], y: np.ndarray, epochs: int, rate: float = 0.02) -> None:
        share = y.mean()
        self._log_odds(texts, y)
        weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
        state = {}

        def adam(name, value, grad, rows=None):
            m, v, t = state.setdefault(name, [np.zeros_like(value), np.zeros_like(value), 0])
            state[name][2] = t = t + 1
            at = slice(None) if rows is None else rows
            m[at] = 0.9 * m[at] + 0.1 * grad
            v[at] = 0.99 * v[at] + 0.01 * grad**2
            value[at] -= rate * (m[at] / (1 - 0.9**t)) / (np.sqrt(v[at] / (1 - 0.99**t)) + 1e-6)

        rng = np.random.RandomState(17)
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for at in range(0, len(order), 64):
                part = order[at : at + 64]
                top, ids, where = self.pooled([texts[i] for i in part], self.tables(), places=True)
                act = np.maximum(top, 0)
                p = 1 / (1 + np.exp(-np.clip(act @ self.out + self.bias, -30, 30)))
                error = (p - y[part]) * weight[part] / len(part)
                back = error[:, None] * self.out * (top > 0)
                adam("out", self.out, act.T @ error + 1e-4 * self.out)
                self.bias -= rate * 5 * error.sum()
                rows, grads = [], []
                for n, w in enumerate(WIDTHS):
                    g = back[:, n * FILTERS : (n + 1) * FILTERS]
                    new = np.zeros_like(self.f[w])
                    for j in range(w):
                        word = ids[(where[n] + j).clip(max=len(ids) - 1)]
                        new[j] = np.einsum("bfd,bf->df", self.e[word].sum(2), g)
                        for k in range(len(BEGINNINGS)):
                            rows.append(word[:, :, k].ravel())
                            grads.append((g[:, :, None] * self.f[w][j].T[None]).reshape(-1, DIM))
                    adam(("f", w), self.f[w], new + 1e-4 * self.f[w])
                    adam(("b", w), self.fb[w], g.sum(0))
                used, place = np.unique(np.concatenate(rows), return_inverse=True)
                flat = np.concatenate(grads)
                total = np.stack([np.bincount(place, flat[:, d]) for d in range(DIM)], 1)
                adam("e", self.e, total, used)
                self.e[PAD] = 0

    def _log_odds(self, texts: list[np.ndarray], y: np.ndarray) -> None:
        """Starts the first axis from the log-odds of words and beginnings, pulled towards 0 for rare ones."""
        seen = np.zeros((2, PAD + 1))
        for text, label in zip(texts, y, strict=True):
            seen[int(label), np.unique(text)] += 1
        prior = np.array([(y == 0).sum(), (y == 1).sum()])
        odds = np.log((seen[1] + 0.5) / (prior[1] + 1)) - np.log((seen[0] + 0.5 * prior[0] / prior[1]) / (prior[0] + 1))
        both = seen.sum(0)
        self.e[:, 0] = np.clip(np.where(both < 4, 0.0, odds * both / (both + 10)), -2, 3) * 0.5
        self.e[PAD] = 0

    def calibrate(self, texts: list[np.ndarray], langs: np.ndarray, y: np.ndarray) -> None:
        """The threshold of best F1 in each language; that of all where a language has few positives."""
        p = self.probability(texts, self.tables())

        def best(p, y):
            order = np.argsort(-p, kind="stable")
            hits = np.cumsum(y[order])
            f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
            at = int(np.argmax(f1))
            after = p[order][at + 1] if at + 1 < len(y) else 0.0
            return float(np.clip((p[order][at] + after) / 2, 0.02, 0.98))

        self.cuts[:] = best(p, y)
        for k in range(len(LANGUAGES)):
            own = langs == k
            if y[own].sum() >= 15:
                self.cuts[k] = best(p[own], y[own])

    def score(self, texts: list[np.ndarray], langs: np.ndarray, tables: dict) -> np.ndarray:
        p, cut = self.probability(texts, tables), self.cuts[langs]
        return np.where(p < cut, CUT * p / cut, CUT + (1 - CUT) * (p - cut) / (1 - cut))


def train(docs: DataFrame, labels: DataFrame, label: str, parts: int, rest: int, max_train: int, epochs: int):
    known = _function_hashes()

    def extract(batches):
        for batch, data, offsets in chunks(batches):
            found = tokens(data, offsets, known)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0].tobytes() for x in found], pa.binary()),
                    pa.array([x[1] for x in found], pa.int32()),
                    batch.column("y").cast(pa.int32()),
                ],
                ["ids", "lang", "y"],
            )

    sample = training_rows(docs.select("doc_id", "text"), labels, label, parts, rest, max_train)
    got = sorted(sample.mapInArrow(extract, "ids binary, lang int, y int").collect())  # max_train rows at most
    y = np.array([r["y"] for r in got], float)
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    texts = [np.frombuffer(r["ids"], np.int32).reshape(-1, len(BEGINNINGS)) for r in got]
    langs = np.array([r["lang"] for r in got])
    mixed = np.random.RandomState(23).permutation(len(y))
    check, learn = mixed[: len(y) // 4], mixed[len(y) // 4 :]
    model = TextCnn()
    if y[learn].min() == y[learn].max() or not y[check].sum():
        check = learn = mixed
    model.fit([texts[i] for i in learn], y[learn], epochs)
    model.calibrate([texts[i] for i in check], langs[check], y[check])
    return model


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    parts: int = 3,
    rest: int = 1,
    max_train: int = 6000,
    epochs: int = 5,
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, label, parts, rest, max_train, epochs))
    known = _function_hashes()

    def score(batches):
        fitted = model.value
        tables = fitted.tables() if not isinstance(fitted, float) else None
        for batch, data, offsets in chunks(batches):
            if tables is None:
                value = np.full(batch.num_rows, fitted)
            else:
                found = tokens(data, offsets, known)
                value = fitted.score([x[0] for x in found], np.array([x[1] for x in found]), tables)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(value)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .mapInArrow(score, f"doc_id {kind}, score double")
        .select(
            "doc_id",
            held_out(F.col("doc_id"), parts, rest).alias("held_out"),
            "score",
            (F.col("score") >= CUT).cast("int").alias("predicted"),
        )
    )
