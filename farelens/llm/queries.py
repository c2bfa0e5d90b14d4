"""Registered queries of the text operators and the SQL they equal where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from farelens.llm import (
    cross_tokens,
    decontaminate,
    exact_dedup,
    hilbert_shards,
    html_crf,
    line_dedup,
    mixing,
    ngram_join,
    pii,
    prefix_trie,
    quality_fm,
    quotes,
    toxicity_cnn,
)
from farelens.llm.common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_classes(table(spark, sf_dir, "documents"), n=4, percent=85)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_cnn.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("copies")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_order(table(spark, sf_dir, "conversations"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract_main_text(table(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_tokens.align(table(spark, sf_dir, "documents"))[0]


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.hilbert_shards(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns_in_order(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.regrown(turns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_quality,
        op3_ngram_join,
        op4_decontamination,
        op5_toxicity,
        op6_exact_dedup,
        op7_mixing,
        op8_quotation_linking,
        op9_pii,
        op10_html,
        op11_token_alignment,
        op12_sharding,
        op13_prefix_trie,
    )
}

ORACLES: dict[str, str] = {
    "op6_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
        g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
        FROM t JOIN g USING (body)
    """,
}
