"""Clean a corpus and encode it: stages over the documents table, each working on all rows that its predecessor kept.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as the next
stage's documents. Every stage but the last returns the columns it was given, also columns of other names; the
last returns doc_id, ids and n_tokens. Null texts, empty tables and repeated rows are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import decontamination, forest, pieces, quality, secrets
from starmart.llm.storage import importable, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that fail the base rules, or whose content lines hold less than half of the words."""
    return quality.retained(docs, quality.trained(docs, importable(spark).read.parquet(f"{sf_dir}/labels.parquet")))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates, the document with the smallest doc_id stays."""
    importable(spark)
    return forest.deduplicated(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontamination.decontaminated(docs, importable(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark."""
    return secrets.redacted(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become piece ids."""
    importable(spark)
    return pieces.encoded(docs).select("doc_id", "ids", "n_tokens")


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Near-duplicate classes, the trained labeller and the tokenizer have no SQL; tests/llm holds brute-force checks.
ORACLE_SQL = None
