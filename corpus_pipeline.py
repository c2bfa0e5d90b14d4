"""The corpus pipeline: quality, exact copies, near copies, benchmark passages, then the mix of sources.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. ``run`` writes each
stage's result as a table in the shared folder and reads it back as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from farelens.llm import decontaminate, exact_dedup, mixing, ngram_join, quality_fm
from farelens.llm.common import table
from farelens.session import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (a score of 0.7 or more)."""
    return quality_fm.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each distinct text: the one with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id.

    Sets of five-word shingles, linked at a Jaccard similarity of 0.8 and more.
    """
    return ngram_join.one_of_each(docs, n=5, percent=80)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target and taken, the words that the mix takes of a document."""
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("mixing sources to target weights", source_mix),
]

#: A trained classifier, classes of links and random rounding have no SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        path = fresh_path(spark, "pipeline-" + name.replace(" ", "-"))
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
