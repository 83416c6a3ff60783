"""Removal of repeated byte strings with a run-length compressed index.

A byte goes when a 200-byte string that covers it also starts anywhere else.

Every 200-byte string has an anchor: its 32-byte piece with the smallest hash.
Equal strings have equal anchors, so strings only need to be compared with
those of the same anchor. Neighbouring strings of a document with the same
anchor form one segment. Anchors that occur once are done with; equal segments
are collapsed and counted before anything is gathered; the distinct segments
of the other anchors are dealt to blocks of bounded size. Each block becomes a
run-length index: the Burrows-Wheeler transform in runs, with the suffix array
sampled at the runs' ends. Text is streamed past it to get, for each position,
the longest match with any other position.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from outletlab.llm.common import U64, prefix_sums, range_hash, text_blocks
from outletlab.session import cut_lineage

MIN_BYTES = 200
ANCHOR_BYTES = 32
BLOCK_BYTES = 1 << 20  # segment bytes of one index on average; it takes some fifty times that memory
HOT_SEGMENTS = 20_000  # an anchor with more distinct segments is dealt by whole strings
SCAN_BYTES = 1 << 18
_PLACE_BITS = U64(24)
_PLACE = (U64(1) << _PLACE_BITS) - U64(1)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[: len(x) - done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, strings, anchor hash, content hash) of every segment: the runs
    of neighbouring MIN_BYTES strings with one anchor, cut where rows end."""
    empty = np.zeros(0, np.int64)
    n = len(data) - MIN_BYTES + 1
    if n <= 0:
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    sums = prefix_sums(data)
    at = np.arange(len(data) - ANCHOR_BYTES + 1)
    piece = range_hash(sums, at, at + ANCHOR_BYTES)
    # the hash's high bits and the place in one number: ties go to the leftmost
    low = _sliding_min((piece & ~_PLACE) | at.astype(np.uint64), MIN_BYTES - ANCHOR_BYTES + 1)[:n]
    place = (low & _PLACE).astype(np.int64)
    inside = np.zeros(n + 1, np.int32)
    long_rows = np.flatnonzero(np.diff(offsets) >= MIN_BYTES)
    np.add.at(inside, offsets[long_rows], 1)
    np.add.at(inside, offsets[long_rows + 1] - MIN_BYTES + 1, -1)
    inside = np.cumsum(inside[:n]) > 0
    first = inside.copy()
    first[1:] &= (place[1:] != place[:-1]) | ~inside[:-1]
    first[offsets[long_rows]] = True
    start = np.flatnonzero(first)
    # a segment ends where the next one starts or its row's strings end
    row_end = offsets[np.searchsorted(offsets, start, side="right")] - MIN_BYTES + 1
    count = np.minimum(np.append(start[1:], n), row_end) - start
    return start, count, piece[place[start]], range_hash(sums, start, start + count + MIN_BYTES - 1)


def _parts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(row, offset in the row, bytes, offsets): blocks of rows as they are, a
    very long row in overlapping parts that hold each string once."""
    size = 8 << 20
    if len(offsets) > 2 or len(data) <= size:
        yield 0, 0, data, offsets
        return
    for a in range(0, len(data) - MIN_BYTES + 1, size):
        part = data[a: a + size + MIN_BYTES - 1]
        yield 0, a, part, np.array([0, len(part)])


def _segment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, _, block, block_offsets in text_blocks(batch.column(2), SCAN_BYTES):
            for _, shift, data, offsets in _parts(block, block_offsets):
                start, count, anchor, content = segments(data, offsets)
                row = np.searchsorted(offsets, start, side="right") - 1
                take = pa.array(row + lo)
                where = (start - offsets[row] + shift) << 8 | count
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(where),
                     pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64))], names=["id", "t", "place", "anchor", "content"])


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of a text, with the suffix
    array sampled at both ends of every run."""

    def __init__(self, text: np.ndarray):
        self.text = text
        order = _suffix_array(text)
        self.order = order
        before = text[order - 1]  # the first suffix wraps around
        head = np.ones(len(order), bool)
        head[1:] = before[1:] != before[:-1]
        head[np.flatnonzero(order == 0)] = True  # the wrapped symbol is a run of its own
        after_wrap = np.flatnonzero(order == 0) + 1
        head[after_wrap[after_wrap < len(order)]] = True
        self.run_start = np.flatnonzero(head)
        self.run_symbol = before[self.run_start]
        self.first_sample = order[self.run_start]
        self.last_sample = order[np.append(self.run_start[1:], len(order)) - 1]

    def matching_statistics(self) -> np.ndarray:
        """For each position the length of its longest match with another.

        Only at the heads of runs is the match with the suffix ranked before
        compared byte by byte; from there the text is streamed: one position
        on, the match is one byte shorter until the next sample.
        """
        n = len(self.text)
        previous = self.order[np.maximum(self.run_start - 1, 0)]
        common = _common_prefix(self.text, self.first_sample, previous)
        common[self.run_start == 0] = 0
        sampled = np.full(n, -1, np.int32)
        sampled[self.first_sample] = common
        place = np.arange(n, dtype=np.int32)
        at = np.maximum.accumulate(np.where(sampled >= 0, place, np.int32(0)))
        with_previous = np.maximum(sampled[at] - (place - at), 0)
        longest = with_previous[self.order]
        longest[:-1] = np.maximum(longest[:-1], longest[1:])
        out = np.empty(n, np.int32)
        out[self.order] = longest
        return out


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    x = padded[:-1] << U64(8) | padded[1:]
    x = x[:-2] << U64(16) | x[2:]
    return (x[:-4] << U64(32) | x[4:])[: len(text)]


def _suffix_array(text: np.ndarray) -> np.ndarray:
    """Prefix doubling from eight bytes on; only open groups are sorted again.
    A group's rank is the place of its first suffix. Blocks are far below
    2**31 bytes, so places are 32-bit numbers and a pair of them is 64 bits."""
    n = len(text)
    key = _words(text)
    active = np.argsort(key, kind="stable").astype(np.int32)
    key = key[active]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.zeros(n + 1, np.int32)  # 0 for the end of the text, then places from 1
    old_first, depth = None, 8
    while len(active):
        first = np.maximum.accumulate(np.where(new, np.arange(len(active), dtype=np.int32), np.int32(0)))
        if old_first is None:
            rank[active] = first + 1
        else:
            rank[active] += first - old_first
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(active)))
        active = active[np.repeat(size > 1, size)]
        key = rank[active].astype(np.int64) << 32 | rank[np.minimum(active + depth, n)]
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        if len(active):
            new = np.concatenate([[True], key[1:] != key[:-1]])
            key >>= 32
            whole = np.concatenate([[True], key[1:] != key[:-1]])
            old_first = np.maximum.accumulate(np.where(whole, np.arange(len(active), dtype=np.int32), np.int32(0)))
        depth *= 2
    out = np.empty(n, np.int32)
    out[rank[:n] - 1] = np.arange(n, dtype=np.int32)
    return out


def _common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, by eight bytes."""
    n, words = len(text), _words(text)
    words = np.append(words, U64(0))
    out = np.zeros(len(a), np.int64)
    live = np.flatnonzero(a != b)
    while len(live):
        x, y = np.minimum(a[live] + out[live], n), np.minimum(b[live] + out[live], n)
        differ = words[x] ^ words[y]
        same = differ == 0
        done = live[~same]
        out[done] += (differ[~same].byteswap().view(np.uint8).reshape(-1, 8) != 0).argmax(axis=1)  # whole bytes that agree
        live = live[same]
        out[live] += 8
        live = live[(a[live] + out[live] < n) & (b[live] + out[live] < n)]
    return np.minimum(out, n - np.maximum(a, b))


def _block_spans(table: pa.Table) -> pa.Table:
    """(id, t, start, end) of the repeated strings of the segments held once.

    The segments are joined by 0xFF, a byte that UTF-8 doesn't have, so a
    match of MIN_BYTES within a segment lies within one elsewhere.
    """
    contents = [c.as_py() for c in table["bytes"].combine_chunks()]
    sizes = np.array([len(c) + 1 for c in contents])
    begin = np.cumsum(sizes) - sizes
    index = RunLengthIndex(np.frombuffer(b"\xff".join(contents) + b"\xff", np.uint8))
    repeated = index.matching_statistics() >= MIN_BYTES
    single = np.flatnonzero(table["n"].to_numpy() == 1)
    mask = np.zeros(len(repeated) + 1, bool)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    # of segments held once, the places whose strings don't reach past the segment
    stop = np.zeros(len(sizes), np.int64)
    stop[single] = (begin + sizes - MIN_BYTES)[single]
    mask[:-1] = repeated & (np.arange(len(owner)) < stop[owner])
    first = np.flatnonzero(mask[:-1] & ~np.concatenate([[False], mask[:-2]]))
    last = np.flatnonzero(mask[:-1] & ~mask[1:])
    rows = owner[first]
    base = (table["place"].to_numpy() >> 8)[rows] - begin[rows]
    return pa.table({"id": table["id"].take(pa.array(rows)), "t": table["t"].take(pa.array(rows)),
                     "start": pa.array(base + first), "end": pa.array(base + last + MIN_BYTES)})


def _slice_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each segment that a document stands for."""
    for batch in batches:
        out, size = [], 0
        for i in range(batch.num_rows):
            data = (batch.column(2)[i].as_py() or "").encode()
            for s in batch.column(3)[i].as_py():
                start = s["place"] >> 8
                out.append((i, s["place"], s["anchor"], s["n"], data[start: start + (s["place"] & 255) + MIN_BYTES - 1]))
                size += len(out[-1][-1])
            if out and (size > 8 << 20 or i == batch.num_rows - 1):
                rows, place, anchor, n, content = zip(*out, strict=True)
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(place, pa.int64()),
                                                  pa.array(anchor, pa.int64()), pa.array(n, pa.int64()), pa.array(content, pa.binary())],
                                                 names=["id", "t", "place", "anchor", "n", "bytes"])
                out, size = [], 0


def _string_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every MIN_BYTES string of segments, as a 128-bit hash."""
    for batch in batches:
        for i in range(batch.num_rows):
            data = np.frombuffer(batch.column(5)[i].as_py(), np.uint8)
            at = np.arange(len(data) - MIN_BYTES + 1)
            halves = [range_hash(prefix_sums(d), at, at + MIN_BYTES).view(np.int64) for d in (data, 255 - data)]
            take = pa.array(np.full(len(at), i))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(at + (batch.column(2)[i].as_py() >> 8)),
                                              batch.column(4).take(take), *map(pa.array, halves)], names=["id", "t", "start", "n", "h1", "h2"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(id, t, start, end) covering the repeated strings of ``docs`` (id, t,
    text); spans may overlap. t is a hash of the text: with the id it tells
    rows apart."""
    key = [docs.schema["id"], docs.schema["t"]]
    longs = lambda *names: [StructField(c, LongType()) for c in names]
    found = cut_lineage(docs.mapInArrow(_segment_batches, StructType([*key, *longs("place", "anchor", "content")])), "segments")
    # stored, so that a hot anchor's rows can be split over tasks when they join it
    again = cut_lineage(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("anchor"), "anchors_again")
    found = cut_lineage(found.join(again, "anchor"), "repeated_anchors")
    classes = cut_lineage(found.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "t", "place")).alias("holder")),
                          "segment_classes")
    # segments held more than once: all of their strings repeat
    copies = (found.join(classes.filter("n > 1").select("anchor", "content"), ["anchor", "content"])
              .select("id", "t", F.shiftright("place", 8).alias("start"),
                      (F.shiftright("place", 8) + F.col("place").bitwiseAND(255) + MIN_BYTES - 1).alias("end")))
    spans = [copies]
    anchors = cut_lineage(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "open_anchors")
    total = classes.join(anchors, "anchor", "left_semi").agg(
        F.sum(F.col("holder.place").bitwiseAND(255) + MIN_BYTES - 1)).first()[0]
    if not total:
        return copies
    needed = (classes.join(anchors, "anchor", "left_semi").select("holder.*", "anchor", "n")
              .groupBy("id", "t").agg(F.collect_list(F.struct("place", "anchor", "n")).alias("parts"))
              .withColumnsRenamed({"id": "__id", "t": "__t"}))
    texts = docs.join(needed, docs["id"].eqNullSafe(F.col("__id")) & (docs["t"] == F.col("__t"))).select("id", "t", "text", "parts")
    contents = cut_lineage(texts.mapInArrow(_slice_batches, StructType([*key, *longs("place", "anchor", "n"), StructField("bytes", BinaryType())])),
                           "segment_bytes")
    hot = anchors.filter(F.col("kinds") > HOT_SEGMENTS).select("anchor")
    dealt = contents
    if not hot.isEmpty():
        strings = contents.join(hot, "anchor", "left_semi").select("id", "t", "place", "anchor", "n", "bytes").mapInArrow(
            _string_batches, StructType([*key, *longs("start", "n", "h1", "h2")]))
        strings = cut_lineage(strings, "hot_strings")
        shared = strings.groupBy("h1", "h2").agg(F.sum("n").alias("c")).filter("c > 1").select("h1", "h2")
        spans.append(strings.filter("n = 1").join(shared, ["h1", "h2"], "left_semi").select("id", "t", "start", (F.col("start") + MIN_BYTES).alias("end")))
        dealt = contents.join(hot, "anchor", "left_anti")
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    spans.append(dealt.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks))).groupBy("block")
                 .applyInArrow(_block_spans, StructType([*key, *longs("start", "end")])))
    out = spans[0]
    for more in spans[1:]:
        out = out.unionByName(more)
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept) of every row of ``docs``.

    spans are the maximal removed byte ranges (start, end) of the UTF-8 text,
    kept the remaining bytes, which may not be whole characters where a span
    cuts one. Null counts as empty; texts under MIN_BYTES lose nothing;
    rows repeating an id and text are copies of each other like any other
    rows; null ids are kept apart by their text; an empty table gives no
    rows; other columns are not read.
    """
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    source = source.select("id", F.xxhash64("text").alias("t"), "text")
    spans = (repeated_spans(source).groupBy("id", "t").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
             .withColumnsRenamed({"id": "__id", "t": "__t"}))
    joined = source.join(spans, source["id"].eqNullSafe(F.col("__id")) & (source["t"] == F.col("__t")), "left").select("id", "text", "spans")

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            sizes, removed, ranges, kept = [], [], [], []
            for text, found in zip(batch.column(1), batch.column(2), strict=True):
                data = text.as_py().encode()
                merged: list[list[int]] = []
                for s in sorted((x["start"], x["end"]) for x in found.as_py() or ()):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                edges = [0, *(e for s in merged for e in s), len(data)]
                sizes.append(len(data))
                removed.append(sum(b - a for a, b in merged))
                ranges.append([{"start": a, "end": b} for a, b in merged])
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(ranges, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                names=[id_col, "n_bytes", "n_removed", "spans", "kept"])

    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), StructField("n_bytes", LongType()),
                         StructField("n_removed", LongType()), StructField("spans", ArrayType(span)), StructField("kept", BinaryType())])
    return joined.mapInArrow(batches, schema)
