"""Line deduplication across documents, in DataFrame functions only.

Lines are exploded, normalised and hashed; documents are counted per hash;
lines over the threshold are dropped everywhere but in the document with the
largest id, and what is left is put together again by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outletlab.session import cut_lineage

MIN_CHARS = 20
MIN_DOCS = 3
BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """ASCII white space stripped at both ends, A-Z lower-cased. lower() is
    much faster than translate() and the same where all is ASCII."""
    stripped = F.btrim(line, F.lit(BLANK))
    return F.when(F.octet_length(stripped) == F.length(stripped), F.lower(stripped)).otherwise(
        F.translate(stripped, UPPER, LOWER))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text, plus n_lines
    (before dropping) and n_dropped.

    A key of at least ``min_chars`` code points found in at least
    ``min_docs`` documents loses all its lines but those in the document with
    the largest id holding it. Null or empty text is one empty line. Each row
    counts as a document; a null id ranks below all others. Rows are matched
    with their dropped lines by id and text hash, so repeated rows and null
    ids keep their own lines. Columns named n_lines or n_dropped are
    replaced; all others pass through.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    lines = docs.select(F.col(id_col).alias("id"), F.xxhash64(body).alias("t"), F.split(body, "\n", -1).alias("lines"))
    keys = F.transform(F.transform("lines", line_key), lambda k: F.when(F.length(k) >= min_chars, F.md5(k.cast("binary"))))
    # each row holds a key once here, so counting rows counts documents
    held = lines.select("id", F.explode(F.array_distinct(F.filter(keys, lambda h: h.isNotNull()))).alias("h"))
    repeated = cut_lineage(held.groupBy("h").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keep_id"))
                           .filter(F.col("n_docs") >= min_docs).drop("n_docs"), "repeated_lines")
    dropped = (lines.select("id", "t", F.posexplode(keys).alias("pos", "h")).filter("h IS NOT NULL")
               .join(repeated, "h").filter(~F.col("id").eqNullSafe(F.col("keep_id")))
               .groupBy("id", "t").agg(F.collect_set("pos").alias("__drop"))
               .select(F.col("id").alias("__drop_id"), F.col("t").alias("__drop_text"), "__drop"))
    whole = (docs.drop("n_lines", "n_dropped").withColumn("__t", F.xxhash64(body))
             .withColumn("__lines", F.split(body, "\n", -1)).drop(text_col))
    joined = whole.join(dropped, whole[id_col].eqNullSafe(F.col("__drop_id")) & (F.col("__t") == F.col("__drop_text")), "left")
    # positions left, by a hash set; __lines is computed below the join, so picking one is a lookup
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__drop")
    text = F.when(F.col("__drop").isNull(), F.array_join("__lines", "\n")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("__lines", i)), "\n"))
    columns = [text.alias(text_col) if c == text_col else F.col(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return joined.select(*columns, F.size("__lines").cast("long").alias("n_lines"),
                         F.when(F.col("__drop").isNull(), 0).otherwise(F.size("__drop")).cast("long").alias("n_dropped"))
