"""Exact deduplication by progressive refinement, in DataFrame functions only.

Texts are equal when identical after every run of ASCII white space became
one space. Groups are refined by length, then by a hash of the first
characters, then by the SHA-256 of the whole text; only rows whose length and
prefix group has at least two rows get to the last, costly step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outletlab.session import cut_lineage

PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    """Null as empty; each run of [\\x20\\x09-\\x0D] as one space. A lone
    space is left alone, which spares most of the replacing."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D\x20]{2,}|[\x09-\x0D]", " ")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text_sha256, keep_id, group_size) of every text held by two rows or more.

    keep_id is the smallest non-null id of the group. Counts are combined
    before the shuffle at each level, so a group holding a third of all rows
    is one row per task; the joins are on keys of the level before and can
    be split by the skew-join rule.
    """
    content = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("body"))
    sizes = content.select("id", F.length("body").alias("n"),
                           F.xxhash64(F.substring("body", 1, PREFIX_CHARS)).alias("p"))
    sizes = cut_lineage(sizes.groupBy("n", "p").agg(F.count(F.lit(1)).alias("c")), "dedup_levels")
    by_length = sizes.groupBy("n").agg(F.sum("c").alias("length_rows")).filter("length_rows > 1")
    by_prefix = sizes.filter("c > 1").join(by_length, "n", "left_semi").select("n", "p")
    survivors = (content.withColumn("n", F.length("body"))
                 .withColumn("p", F.xxhash64(F.substring("body", 1, PREFIX_CHARS)))
                 .join(by_prefix, ["n", "p"], "left_semi"))
    return (survivors.select("id", F.sha2("body", 256).alias("text_sha256"))
            .groupBy("text_sha256").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .filter("group_size > 1"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Nulls and edge cases: a null text equals the empty one; a null id stays
    only when no other row of its group has an id (keep_id is then null);
    rows repeating the id that stays are the same document, so all of them
    are marked kept; an empty table gives no rows; other columns of ``docs``,
    whatever their names, are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.sha2(normalised(F.col(text_col)), 256).alias("text_sha256"))
    # written once: joined as a stored table, a hot text's rows can be split over tasks
    groups = cut_lineage(duplicate_groups(docs, id_col, text_col), "duplicate_groups")
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return (rows.join(groups, "text_sha256", "left")
            .select("id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    "text_sha256")
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))
