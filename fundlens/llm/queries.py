"""The queries of the operators, one per operator, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bpe, decontaminate, divergence, html, jaccard, pii, prefix_trie, quality, sharding, simhash, suffixes,
               token_counts, toxicity)


#: Rows and bytes of the batches that go to Python: a worker holds a few of them at a time.
BATCH_ROWS, BATCH_BYTES = 2000, "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def op1_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op3_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_documents(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeated_bytes": op1_repeated_bytes,
    "op2_pii": op2_pii,
    "op3_benchmark_leaks": op3_benchmark_leaks,
    "op4_html_text": op4_html_text,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_toxicity": op6_toxicity,
    "op7_quality": op7_quality,
    "op8_token_counts": op8_token_counts,
    "op9_shards": op9_shards,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_source_divergence": op12_source_divergence,
    "op13_simhash": op13_simhash,
}

#: Where SQL can express the operator's result.
SQL: dict[str, str] = {
    "op1_repeated_bytes": suffixes.SQL,
    "op5_jaccard_join": jaccard.SQL,
    "op7_quality": quality.SQL,
    "op11_conversation_trie": prefix_trie.SQL,
    "op12_source_divergence": divergence.SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
