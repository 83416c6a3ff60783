"""Source divergence audit: how the words of each source differ, by language.

One ``bytes.translate`` lowers A-Z and blanks every separator of a text,
``bytes.split`` and a Counter a document give its terms. Tasks add the
Counters up by (lang, source) in tables of bounded size and send only those
sums, which Spark combines to one sparse row a (lang, source, term).

A group's share of a term it lacks is a constant, so two groups are compared by
what each has alone (a histogram of its counts) and a correction for the terms
that both have; nothing is made dense.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outletlab.llm.common import text_parts
from outletlab.session import cut_lineage

MIN_DOCUMENTS = 30  # documents of a language that hold a kept term
TERM_RANKS = 50
HELD_TERMS = 100_000  # sums a task holds before it sends them

# letters and all bytes of other characters are terms, the rest separates
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SEPARATOR = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]")


def document_terms(text: bytes) -> Counter:
    """How often each term occurs in a text."""
    terms: Counter = Counter()
    for part in text_parts(text, SEPARATOR):
        terms.update(part.translate(TERM_BYTES).split())
    return terms


def _sums(held: dict) -> pa.RecordBatch:
    """The sums of each group, and a row without term that says it occurs."""
    columns: list[list] = [[], [], [], [], []]
    for (lang, source), (documents, places) in held.items():
        columns[0] += [lang] * (len(documents) + 1)
        columns[1] += [source] * (len(documents) + 1)
        columns[2] += [None, *documents]
        columns[3] += [0, *documents.values()]
        columns[4] += [0, *(places[t] for t in documents)]
    kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    arrays[2] = arrays[2].cast(pa.string())
    return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "df", "c"])


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict = defaultdict(lambda: (Counter(), Counter()))
    size = 0
    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns[:2]), batch.column(2), strict=True):
            documents, places = held[(lang, source)]
            before = len(documents)
            terms = document_terms(text.as_py())
            documents.update(terms.keys())
            places.update(terms)
            size += len(documents) - before
            if size > HELD_TERMS:
                yield _sums(held)
                held.clear()
                size = 0
    if held:
        yield _sums(held)


def _share(count: str, total: str, terms: str) -> Column:
    """1 + floor(10 ** 9 * (count + 5) / (total + 5 * terms)), exactly."""
    return F.expr(f"1 + (CAST(1000000000 AS DECIMAL(10,0)) * CAST({count} + 5 AS DECIMAL(20,0))) "
                  f"div CAST(greatest({total} + 5 * {terms}, 1) AS DECIMAL(20,0))")


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(order).cast("int"))


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      min_documents: int = MIN_DOCUMENTS, term_ranks: int = TERM_RANKS) -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part ``pair``: for each source of a language every other one, with the
    sum over all kept terms of the differences of their shares; part ``term``:
    the kept terms whose share is above the language's by most, to rank
    ``term_ranks``. Kept are terms in ``min_documents`` documents of the
    language. Null text, lang and source count as ''. Repeated rows are
    documents of their own. A language without kept terms has pairs of value 0
    and no terms. An empty table gives no rows; other columns are not read.
    """
    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col, text_col)]
    source = docs.select(plain[0].alias("lang"), plain[1].alias("source"), plain[2].cast("binary").alias("text"))
    sums = source.mapInArrow(_term_batches, "lang string, source string, term string, df long, c long")
    counts = cut_lineage(sums.groupBy("lang", "source", "term").agg(F.sum("df").alias("df"), F.sum("c").alias("c")), "group_terms")
    kept = (counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("c").alias("all_c"))
            .filter(F.col("df") >= min_documents))
    kept = cut_lineage(kept.select("lang", "term", "all_c"), "kept_terms")
    languages = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all_c").alias("all_n"))
    held = cut_lineage(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "c", "all_c"), "kept_counts")
    totals = held.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    groups = (counts.filter("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left").join(languages, "lang", "left")
              .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "all_n")]))
    groups = cut_lineage(groups.withColumn("p0", _share("0", "n", "v")), "groups")
    shares = cut_lineage(held.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "c", "p0", _share("c", "n", "v").alias("p"), _share("all_c", "all_n", "v").alias("lang_p")), "shares")

    above = shares.filter("p > lang_p").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("lang_p")).alias("value"))
    terms = _ranked(above).filter(F.col("rank") <= term_ranks).withColumn("part", F.lit("term"))

    other = groups.select("lang", F.col("source").alias("source2"), F.col("p0").alias("q0"))
    pairs = groups.select("lang", "source", "v", "p0").join(other, "lang").filter("source <> source2")
    histogram = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("k"))
    alone = (histogram.join(groups.select("lang", "source", "p0"), ["lang", "source"]).join(other, "lang").filter("source <> source2")
             .groupBy("lang", "source", "source2").agg(F.sum(F.expr("k * (abs(p - q0) - abs(p0 - q0))")).alias("extra")))
    theirs = shares.select("lang", "term", F.col("source").alias("source2"), F.col("p").alias("q"), F.col("p0").alias("q0"))
    both = (shares.join(theirs, ["lang", "term"]).filter("source < source2").groupBy("lang", "source", "source2")
            .agg(F.sum(F.expr("abs(p - q) - abs(p - q0) - abs(p0 - q) + abs(p0 - q0)")).alias("extra")))
    turned = lambda d: d.select("lang", F.col("source2").alias("source"), F.col("source").alias("source2"), "extra")
    extra = (alone.unionByName(turned(alone)).unionByName(both).unionByName(turned(both))
             .groupBy("lang", "source", "source2").agg(F.sum("extra").alias("extra")))
    value = F.col("v") * F.abs(F.col("p0") - F.col("q0")) + F.coalesce("extra", F.lit(0))
    apart = pairs.join(extra, ["lang", "source", "source2"], "left").select("lang", "source", F.col("source2").alias("item"), value.alias("value"))
    names = ["lang", "source", "part", "item", "value", "rank"]
    return _ranked(apart).withColumn("part", F.lit("pair")).select(*names).unionByName(terms.select(*names))
