"""Which labelled rows a classifier may learn from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column, parts: int, rest: int) -> Column:
    """True for documents that are kept for testing: crc32 of the id as text, modulo ``parts``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == rest, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, parts: int, rest: int, bound: int) -> DataFrame:
    """Columns of ``docs`` and ``y`` for at most ``bound`` labelled documents outside the test part.

    Ids are drawn by hash, so the sample is the same however the tables are partitioned. Rows without
    an id or a label are not used; of several labels of one id the largest counts.
    """
    ids = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), parts, rest))
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(bound)
    )
    return docs.join(F.broadcast(ids), docs["doc_id"] == ids["label_id"]).drop("label_id")  # bound rows at most
