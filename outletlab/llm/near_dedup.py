"""Near-duplicate detection: fast similarity sketching, banding, exact check.

Documents are sets of five-word shingles. A sketch of 120 coordinates is
filled in rounds: in each of the first 120 rounds every shingle is thrown
into one hashed bin, in the next 120 into a fixed bin each, and a bin keeps
the smallest (round, hash) it got, so no coordinate stays empty. Bands of
coordinates propose pairs, of as many as the threshold allows (``band_rows``);
every link is confirmed on the full sets.

Groups are never expanded into all pairs. Equal sets collapse to one
representative first. In a band's bucket each member is compared with one
centre, the member that shares most bands; the verified links are contracted to
components. What is left in buckets that still hold several components is finished exactly, by what each document does not have in
common with its bucket's centre: two documents can only be close if they share
enough of these differences, so each posts its rarest ones (prefix filter) and
documents of different components that meet at one are verified. Nothing is
capped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from outletlab.llm.common import U64, mix, runs, text_blocks, word_hashes
from outletlab.session import cut_lineage

SHINGLE_WORDS = 5
PERCENT = 85  # op4: link when 100 * intersection >= PERCENT * union
COORDINATES = 120
MISSED = 1e-6  # largest probability that a pair at the threshold shares no band

BLANKS = np.zeros(256, bool)
BLANKS[[9, 10, 11, 12, 13, 32]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
_WORD_FACTORS = mix(np.arange(101, 101 + SHINGLE_WORDS, dtype=np.uint64)) | U64(1)
_ROUND_SEEDS = mix(np.arange(7001, 7001 + 2 * COORDINATES, dtype=np.uint64))
_BAND_FACTORS = mix(np.arange(301, 301 + COORDINATES, dtype=np.uint64)) | U64(1)
_LOW48 = U64((1 << 48) - 1)


def band_rows(percent: int) -> int:
    """Coordinates a band, the most that let a pair at the threshold share no
    band with a probability below MISSED: 5 for 85, 4 for 80."""
    return max(r for r in range(1, COORDINATES + 1)
               if COORDINATES % r == 0 and (1 - (percent / 100) ** r) ** (COORDINATES // r) < MISSED)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every distinct shingle, ordered by row and hash."""
    low = ASCII_LOWER[data]
    start, end = runs(~BLANKS[data], offsets)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = word_hashes(low, start, end)
    row = np.searchsorted(offsets, start, side="right") - 1
    n_words = np.bincount(row, minlength=len(offsets) - 1)
    position = np.arange(len(word)) - (np.cumsum(n_words) - n_words)[row]
    left = n_words[row] - position  # words from here to the end of the row
    take = (left >= SHINGLE_WORDS) | (position == 0)
    at = np.flatnonzero(take)
    padded = np.concatenate([word, np.zeros(SHINGLE_WORDS, np.uint64)])
    value = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE_WORDS):
        value += np.where(left[at] > k, padded[at + k] * _WORD_FACTORS[k], U64(0))
    value = mix(value + np.minimum(left[at], SHINGLE_WORDS).astype(np.uint64))
    row = row[at]
    order = np.argsort(value)
    order = order[np.argsort(row[order].astype(np.uint16 if len(offsets) < 65536 else np.int64), kind="stable")]
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def sketch_sets(row: np.ndarray, value: np.ndarray, n_rows: int) -> np.ndarray:
    """One sketch a row; rows without shingles keep the largest value everywhere."""
    empty = U64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n_rows * COORDINATES, empty, np.uint64)
    for i in range(2 * COORDINATES):
        if not len(row):
            break
        x = mix(value ^ _ROUND_SEEDS[i])
        bins = (x >> U64(48)).astype(np.int64) % COORDINATES if i < COORDINATES else i - COORDINATES
        np.minimum.at(out, row * COORDINATES + bins, (x & _LOW48) | U64(i << 48))
        open_rows = (out.reshape(n_rows, COORDINATES) == empty).any(axis=1)
        more = open_rows[row]
        row, value = row[more], value[more]
    return out.reshape(n_rows, COORDINATES)


def _sketch_batches(batches: Iterator[pa.RecordBatch], rows_a_band: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for lo, hi, data, offsets in text_blocks(batch.column(1)):
            n = hi - lo
            row, value = shingle_sets(data, offsets)
            sizes = np.bincount(row, minlength=n)
            sums = [np.zeros(n, np.uint64) for _ in range(2)]
            for s, seed in zip(sums, (U64(0x51ED2701), U64(0xA0761D64)), strict=True):
                np.add.at(s, row, mix(value ^ seed))
            bands = sketch_sets(row, value, n) * _BAND_FACTORS
            bands = bands.reshape(n, -1, rows_a_band).sum(axis=2, dtype=np.uint64)
            keys = mix(bands + np.arange(bands.shape[1], dtype=np.uint64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * keys.shape[1]),
                                             pa.array(keys.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, n), pa.array(sizes.astype(np.int64)), *(pa.array(s.view(np.int64)) for s in sums), lists],
                names=["id", "n", "s1", "s2", "bands"])


def _linked_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, text_a, text_b) whose full sets meet the threshold."""
    for batch in batches:
        a, b, text_a, text_b = batch.columns
        for lo, hi, data, offsets in text_blocks(text_a):
            n = hi - lo
            row, value = shingle_sets(data, offsets)
            size = np.bincount(row, minlength=n)
            shared = np.zeros(n, np.int64)
            for first, last, data_b, offsets_b in text_blocks(text_b.slice(lo, n)):
                row_b, value_b = shingle_sets(data_b, offsets_b)
                size[first:last] += np.bincount(row_b, minlength=last - first)
                mine = slice(*np.searchsorted(row, [first, last]))
                rows = np.concatenate([row[mine], row_b + first])
                values = np.concatenate([value[mine], value_b])
                order = np.lexsort((values, rows))
                rows, values = rows[order], values[order]
                both = (rows[1:] == rows[:-1]) & (values[1:] == values[:-1])
                shared += np.bincount(rows[1:][both], minlength=n)
            keep = pa.array(np.flatnonzero(100 * shared >= percent * (size - shared)) + lo)
            yield pa.RecordBatch.from_arrays([a.take(keep), b.take(keep)], names=["a", "b"])


def _difference_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(centre, id, h) of every shingle that only one of the two texts has."""
    for batch in batches:
        centre, ident, text_c, text = batch.columns
        for lo, hi, data, offsets in text_blocks(text):
            row, value = shingle_sets(data, offsets)
            for first, last, data_c, offsets_c in text_blocks(text_c.slice(lo, hi - lo)):
                row_c, value_c = shingle_sets(data_c, offsets_c)
                mine = slice(*np.searchsorted(row, [first, last]))
                rows, values = np.concatenate([row[mine], row_c + first]), np.concatenate([value[mine], value_c])
                order = np.lexsort((values, rows))
                rows, values = rows[order], values[order]
                same = (rows[1:] == rows[:-1]) & (values[1:] == values[:-1])
                alone = ~(np.append(same, False) | np.append(False, same))
                take = pa.array(rows[alone] + lo)
                yield pa.RecordBatch.from_arrays([centre.take(take), ident.take(take), pa.array(values[alone].view(np.int64))],
                                                 names=["centre", "rep", "h"])


def comparable(n: str, m: str, percent: int) -> Column:
    """Length filter: sets of these sizes can meet the threshold."""
    return (F.lit(100) * F.least(n, m)) >= (F.lit(percent) * F.greatest(n, m))


def may_differ(total: Column, percent: int) -> Column:
    """Shingles in which two sets of ``total`` shingles together may differ."""
    return F.floor(total * (100 - percent) / (100 + percent))


def difference_posts(nodes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Posts (centre, h, rep, n, label, d, place, largest) of ``nodes`` (centre,
    rep, n, label) for an exact prefix-filter join on D, the symmetric
    difference with the centre.

    |x △ y| = |D(x) △ D(y)|, so with T = may_differ(|x| + |y|) a link
    needs |D(x) ∩ D(y)| >= o = (|D(x)| + |D(y)| - T) / 2. If o <= 0, x and y
    are both linked with the centre itself, which has been tested, and have its
    label. Else, with differences in one order, the rarest first, the first that
    they share has a place (from 0) of at most |D(x)| - o in x and |D(y)| - o in
    y; the two places add up to T at most. Differences of one document alone
    take their places in the order but join nothing, so what has over T / 2 of
    them meets only what has fewer. ``largest`` is the T of the largest partner.

    Posted is what can still meet: another label at the same difference, and
    the smallest place there within T.
    """
    named = lambda a, b: texts.select(F.col("id").alias(a), F.col("text").alias(b))
    both = nodes.select("centre", "rep").join(named("rep", "text"), "rep").join(named("centre", "text_c"), "centre")
    schema = StructType([nodes.schema["centre"], nodes.schema["rep"], StructField("h", LongType())])
    rows = cut_lineage(both.select("centre", "rep", "text_c", "text").mapInArrow(_difference_batches, schema), "differences")
    held = rows.groupBy("centre", "h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    sizes = rows.groupBy("centre", "rep").agg(F.count(F.lit(1)).alias("d"))
    largest = may_differ(F.col("n") + F.floor(F.col("n") * 100 / percent), percent)
    ordered = (rows.join(held, ["centre", "h"]).groupBy("centre", "rep").agg(F.array_sort(F.collect_list(F.struct("c", "h"))).alias("in_order"))
               .join(sizes, ["centre", "rep"]).join(nodes, ["centre", "rep"])
               .withColumn("alone", F.col("d") - F.size("in_order")).withColumn("largest", largest))
    places = (F.col("largest") + 1 - F.col("alone")).cast("int")
    posts = (ordered.filter(places > 0)
             .select("centre", "rep", "n", "label", "d", "largest", "alone", F.posexplode(F.slice("in_order", F.lit(1), places)).alias("place", "at"))
             .select("centre", "at.h", "rep", "n", "label", "d", "largest", (F.col("alone") + F.col("place")).alias("place")))
    posts = cut_lineage(posts, "posts")
    mixed = (posts.groupBy("centre", "h").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("place").alias("first"), F.max("n").alias("widest"))
             .filter("lo <> hi").select("centre", "h", "first", "widest"))
    met = posts.join(mixed, ["centre", "h"]).withColumn("largest", F.least("largest", may_differ(F.col("n") + F.col("widest"), percent)))
    return cut_lineage(met.filter("place + first <= largest").drop("first", "widest"), "posts")


def difference_pairs(nodes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (rep, rep2) of ``nodes`` with the same centre and different labels
    that can meet the threshold: of each, the one with the smaller place (at
    most half of T) comes first, so that documents that are all far from each
    other are not paired. See ``difference_posts``."""
    posts = difference_posts(nodes, texts, percent)
    near = posts.filter("2 * place <= largest")
    other = posts.select("centre", "h", *[F.col(c).alias(f"{c}2") for c in ("rep", "n", "label", "d", "place")])
    most = may_differ(F.col("n") + F.col("n2"), percent)
    overlap = F.ceil((F.col("d") + F.col("d2") - most) / 2)
    return (near.join(other, ["centre", "h"])
            .filter((F.col("label") != F.col("label2")) & comparable("n", "n2", percent) & (F.col("place") <= F.col("place2"))
                    & (F.col("place") <= F.col("d") - overlap) & (F.col("place2") <= F.col("d2") - overlap))
            .select("rep", "rep2"))


def root_edges(links: DataFrame) -> DataFrame:
    """(v, u) for every node v of ``links`` (a, b) that is not the smallest of
    its component: u is. Alternates large-star and small-star steps; minima are
    combined before the shuffle and the joins can be split, so a hub of any
    degree is spread out. Runs until every node points straight at its root: no
    node points at two, and none that is pointed at points on.
    """
    edges = cut_lineage(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).filter("u <> v"), "edges")
    more = not edges.isEmpty()
    while more:
        both = edges.select("v", "u").union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = cut_lineage(both.join(low, "v").filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).filter("u <> v"), "edges")
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (large.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
                 .union(low.select("v", F.col("m").alias("u"))).filter("u <> v").distinct())
        edges = cut_lineage(small, "edges")
        ends = edges.select(F.col("v").alias("node"), "u").union(edges.select(F.col("u").alias("node"), F.lit(None).alias("u")))
        points = ends.groupBy("node").agg(F.count("u").alias("out"), F.count(F.lit(1)).alias("all"))
        more = points.filter("out > 1 OR (out = 1 AND all > 1)").agg(F.count(F.lit(1))).first()[0] > 0
    return edges


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest
    node reachable. See ``root_edges``; a node linked with itself alone has no row."""
    edges = root_edges(links)
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
        edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``; sets are
    linked from a similarity of ``percent`` up.

    component_id is the smallest id reachable over links. A null or blank text
    has an empty set and is linked with nothing; fewer than five words make one
    shingle. Rows with a null id are linked with nothing (component_id null,
    kept). Rows repeating an id count as one node. An empty table gives no
    rows; other columns are not read. Sets of equal size and equal 128-bit
    sums of hashed shingles are taken as equal.
    """
    id_type = docs.schema[id_col].dataType
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    longs = [StructField(c, LongType()) for c in ("n", "s1", "s2")]
    sketches = cut_lineage(source.mapInArrow(partial(_sketch_batches, rows_a_band=band_rows(percent)), StructType(
        [StructField("id", id_type), *longs, StructField("bands", ArrayType(LongType()))])), "sketches")
    filled = sketches.filter("n > 0 AND id IS NOT NULL")
    classes = filled.groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"))
    rows = (filled.join(classes.select("rep"), F.col("id") == F.col("rep"), "left_semi")
            .select(F.explode("bands").alias("key"), F.col("id").alias("rep"), "n").distinct())
    rows = cut_lineage(rows, "band_rows")
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    company = F.sum("c").over(Window.partitionBy("rep")).alias("company")
    buckets = cut_lineage(rows.join(shared, "key").select("rep", "key", "n", company), "buckets")
    nodes = buckets.select(F.col("rep").alias("id")).distinct()
    # always dealt by id: a plan that broadcast the ids of a small corpus would say nothing about a large one
    texts = cut_lineage(source.join(nodes.hint("merge"), "id", "left_semi"), "candidate_texts")

    def linked(pairs: DataFrame) -> DataFrame:
        """Of the candidate pairs those that meet the threshold, as (a, b)."""
        pairs = pairs.select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct()
        with_texts = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
                      .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b"))
        return cut_lineage(with_texts.select("a", "b", "text_a", "text_b").mapInArrow(partial(_linked_batches, percent=percent), pairs.schema), "links")

    def root_of(rows: DataFrame, roots: DataFrame, column: str) -> DataFrame:
        """``rows`` with ``column`` replaced by its root, if it has one."""
        known = roots.select(F.col("v").alias("__node"), F.col("u").alias("__root"))
        return rows.join(known, F.col(column) == F.col("__node"), "left").withColumn(
            column, F.coalesce("__root", column)).drop("__node", "__root")

    best = F.min(F.struct((-F.col("company")).alias("o"), "rep", "n")).alias("c")
    centres = cut_lineage(buckets.groupBy("key").agg(best).select("key", F.col("c.rep").alias("rep2"), F.col("c.n").alias("n2")), "centres")
    to_centre = buckets.join(centres, "key").filter((F.col("rep") != F.col("rep2")) & comparable("n", "n2", percent))
    roots = root_edges(linked(to_centre))
    labelled = cut_lineage(root_of(buckets.withColumn("label", F.col("rep")), roots, "label"), "labelled")
    mixed = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("key")
    open_members = (labelled.join(mixed, "key", "left_semi").join(centres.select("key", F.col("rep2").alias("centre")), "key")
                    .select("centre", "rep", "n", "label").distinct())
    more = linked(difference_pairs(cut_lineage(open_members, "open_members"), texts, percent))
    joined = root_edges(root_of(root_of(more, roots, "a"), roots, "b"))  # roots that belong together
    # stored, so that the rows of a hot set can be split over tasks when they join it
    found = cut_lineage(root_of(root_of(classes.withColumnRenamed("rep", "component"), roots, "component"), joined, "component"), "classes")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return (sketches.select("id", "n", "s1", "s2").join(found, ["n", "s1", "s2"], "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                    F.col("id").eqNullSafe(component).alias("kept")))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component. The ids
    that go are stored first: where they are few, their known size lets the
    planner broadcast them and leave the texts in place."""
    gone = near_duplicates(docs, id_col, text_col, percent).filter("NOT kept").select(F.col(id_col).alias("__gone")).distinct()
    gone = cut_lineage(gone, "near_copies")
    return docs.join(gone, docs[id_col] == F.col("__gone"), "left_anti")
