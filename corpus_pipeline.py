"""Training-corpus pipeline over the documents table.

STAGES are applied in order; each stage's rows are written as Parquet in the
shared checkpoint folder and read again as the next one's documents, so that a
lost executor never sends work further back than the stage that is running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outletlab.llm.decontaminate import decontaminate
from outletlab.llm.language_id import UNKNOWN, fit, held_out, label_languages
from outletlab.llm.line_dedup import line_dedup
from outletlab.llm.near_dedup import near_dedup
from outletlab.llm.packing import packed_documents
from outletlab.session import cut_lineage

MIN_LANGUAGE_SHARE = 0.15  # of the way from an even guess over the languages to certainty; a text whose best language stays below has none
NEAR_PERCENT = 80  # shared share of five-word shingles from which texts are near duplicates; op4's contract has 85


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a letter and reads as one of the languages:
    with k of them the best one's mean probability is above the even 1 / k by
    MIN_LANGUAGE_SHARE of what is left to 1."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    even = 1 / max(len(model.languages) if model else 1, 1)
    least = even + MIN_LANGUAGE_SHARE * (1 - even) if even < 1 else 0.0
    rejected = (label_languages(docs, model).filter((F.col("lang_pred") == UNKNOWN) | (F.col("score") < least))
                .select(F.col("doc_id").alias("__rejected")).distinct())
    rejected = cut_lineage(rejected, "rejected")  # stored: a small set is broadcast by its known size
    return docs.join(rejected, docs["doc_id"].eqNullSafe(F.col("__rejected")), "left_anti")


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that repeat; n_chars follows the text."""
    cleaned = line_dedup(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, linked from a similarity of 0.80 up."""
    return near_dedup(docs, percent=NEAR_PERCENT)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return packed_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", repeated_lines),
    ("near_dedup", near_duplicates),
    ("decontaminate", benchmark_free),
    ("packing", packing),
]

# Language identification, sketching and edit distance can't be written in SQL;
# tests/llm compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
