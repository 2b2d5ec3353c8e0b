"""A training-data pipeline over ``documents``.

Each stage gets what its predecessor kept, written as Parquet and read again,
and returns rows with the columns of ``documents`` (the last one adds token
columns). A stage decides by the operator named; only the columns that it needs
go through Python, and only the similarity join shuffles texts.

Cases: null texts pass every filter (no toxicity, no link, no leak) and stay
null; texts are handled whole; equal texts leave one document, that of
the least id; rows that repeat an id with an equal text are one document and
stay or go together; empty tables pass through; columns beyond those of ``documents`` are
carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.llm import bpe, decontaminate, jaccard, pii, toxicity
from fundlens.llm.queries import table
from fundlens.llm.shared import written

#: Entries that a task keeps of the tokenizer's: few, and gone with the task, as its worker works for all stages in turn.
MAX_CACHED = 50_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity (6): documents scored at or above the threshold go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.score(F.col("text"), model) < toxicity.THRESHOLD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (5): of each group of linked documents the least id stays."""
    groups = jaccard.join_documents(docs, counted=False)
    copies = groups.filter("doc_id <> component_id").select("doc_id")
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (3): documents that hold a benchmark item go."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII (2): personal data is replaced by its kind in brackets."""
    return (docs.withColumn("text", pii.redacted(F.col("text")))
            .withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
            .select(docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE (10): adds the number of tokens and the digests of ids and of the decoded text."""
    encoded = bpe.encoding_digest(F.col("text"), max_cached=MAX_CACHED, kept=False)
    return docs.withColumn("_e", encoded).select(*docs.columns, "_e.*")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("pii", redact_pii),
    ("byte_bpe", encode),
]

#: SQL can express neither the trained classifier nor the encoding; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
