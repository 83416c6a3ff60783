"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outletlab.llm.chat import TURN_SCHEMAS, format_tool_calls, turn_calls
from outletlab.llm.decontaminate import contamination
from outletlab.llm.divergence import source_divergence
from outletlab.llm.exact_dedup import exact_dedup
from outletlab.llm.filter_audit import filter_audit
from outletlab.llm.html_text import extract_text
from outletlab.llm.language_id import fit, held_out, label_languages
from outletlab.llm.licenses import license_scan
from outletlab.llm.line_dedup import line_dedup
from outletlab.llm.near_dedup import near_duplicates
from outletlab.llm.oracle import ORACLE_SQL
from outletlab.llm.packing import packed_documents
from outletlab.llm.simhash import simhash_components
from outletlab.llm.substring_dedup import remove_repeats


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).withColumn("n_chars", F.length("text").cast("long"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    return label_languages(docs, model).withColumn("held_out", held_out(F.col("doc_id")))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"))
    held = F.transform("blocks", lambda b: b["containment"])
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(F.array_max(held), F.lit(0.0)))
    labels = F.array_sort(F.array_union("base_labels", F.transform("blocks", lambda b: b["label"])))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                        F.array_join("base_labels", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = turn_calls(table(spark, sf_dir, "conversations"))
    return format_tool_calls(calls, results, TURN_SCHEMAS)


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_html_text": op2_html_text,
    "op3_language_id": op3_language_id,
    "op4_near_dedup": op4_near_dedup,
    "op5_packing": op5_packing,
    "op6_license_scan": op6_license_scan,
    "op7_decontaminate": op7_decontaminate,
    "op8_line_dedup": op8_line_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_chat_format": op10_chat_format,
    "op11_simhash_dedup": op11_simhash_dedup,
    "op12_source_divergence": op12_source_divergence,
    "op13_filter_audit": op13_filter_audit,
}

__all__ = ["QUERIES", "ORACLE_SQL"]
