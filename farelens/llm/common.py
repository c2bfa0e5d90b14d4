"""Helpers shared by the text operators: vectorised word hashing, Arrow chunks, components."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.session import fresh_path, stage

CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.RandomState(20240501).randint(1, 2**63 - 1, 256, dtype=np.int64).astype(np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the tasks, which may not have it installed; once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    shared = fresh_path(spark, "package") + "/farelens-package.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(shared)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(packed.getvalue()))
    out.close()
    spark.sparkContext.addPyFile(shared)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of it in upper or lower case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """``df`` with all its columns, without the rows whose ``key`` is in ``gone``'s only column; null is a key like any other."""
    name = free_name(df, "gone")
    gone = gone.toDF(name).distinct()
    return df.join(gone, key.eqNullSafe(F.col(name)), "left_anti")


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` in a table of the shared folder, each row with a number of its own, and that column's name.

    The numbers tell rows apart whose ids are null or repeat; they stay the same however often the table is read.
    """
    number = free_name(df, "row_number")
    return stage(df.withColumn(number, F.monotonically_increasing_id()), name), number


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values so that every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


class Words:
    """Words of a run of texts: their hashes, byte ranges and the range of words of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = _LOWER[data]
        blank = _SPACE[data]
        first = np.ones(len(data) + 1, bool)
        first[1:] = np.append(blank[1:], True) if len(data) else True
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        before = np.ones(len(data), bool)
        before[1:] = blank[:-1]
        self.data = data
        self.start = np.flatnonzero(~blank & (before | cut[:-1]))
        after = np.ones(len(data), bool)
        after[:-1] = blank[1:]
        self.end = np.flatnonzero(~blank & (after | cut[1:])) + 1
        up, down = _power(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
        self._sums, self._down = sums, down
        self.hash = self.beginnings(len(data) + 1)
        self.bounds = np.searchsorted(self.start, offsets)

    def beginnings(self, size: int) -> np.ndarray:
        """Hashes of the first ``size`` bytes of each word, of the whole word if it is shorter."""
        end = np.minimum(self.end, self.start + size)
        return mix((self._sums[end] - self._sums[self.start]) * self._down[self.start])


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string column; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cuts batches so that each holds few bytes of text, one whole row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = text_buffers(batch.column(text))
        row = 0
        while row < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1
            last = min(max(last, row + 1), batch.num_rows)
            at = offsets[row : last + 1]
            yield batch.slice(row, last - row), data[at[0] : at[-1]], at - at[0]
            row = last


def components(spark: SparkSession, edges: DataFrame, name: str) -> DataFrame:
    """Connected components of the links (a, b): rows (node, root), root the smallest node.

    Alternates two star steps, each a minimum per node and a join. A step's result is a table in the
    shared folder, so nothing is recomputed when an executor is lost, and a node with very many links
    is only ever a join key, which adaptive execution splits.
    """
    edges = stage(edges.where("a <> b").selectExpr("greatest(a, b) a", "least(a, b) b").distinct(), f"{name}-links")
    while not _is_forest(edges):
        both = edges.unionByName(edges.selectExpr("b a", "a b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) m")
        large = both.join(least, "a").where("b > a").selectExpr("b a", "m b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").selectExpr("b a", "m b").unionByName(least.selectExpr("a", "m b"))
        edges = stage(small.where("a <> b").distinct(), f"{name}-links")
    return edges.selectExpr("a node", "b root")


def _is_forest(edges: DataFrame) -> bool:
    """Whether every node has one link and no linked node is another's root."""
    several = edges.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
    between = edges.select("a").join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
    return several.unionByName(between).isEmpty()
