"""The operators over their whole tables, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import archives, decontamination, forest, html, language, lines, periods, pieces, quality, resampling, secrets, substrings, urls
from starmart.llm.storage import importable


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(_table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removed(_table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.judged(docs, quality.trained(docs, _table(spark, sf_dir, "labels"))).drop("content_share")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language.predicted(docs, language.learned(docs)).drop("proportions")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(_table(spark, sf_dir, "pages"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(_table(spark, sf_dir, "pages"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(_table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.joined(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digest(periods.planted(_table(spark, sf_dir, "documents")))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scans": op1_secret_scans,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_warc": op3_warc,
    "op4_quality_rules": op4_quality_rules,
    "op5_language_id": op5_language_id,
    "op6_html_extraction": op6_html_extraction,
    "op7_url_filters": op7_url_filters,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_decontamination": op10_decontamination,
    "op11_resampling": op11_resampling,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_line_dedup": op13_line_dedup,
}
