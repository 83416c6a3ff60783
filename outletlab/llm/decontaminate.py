"""Benchmark decontamination by pigeonhole edit matching.

A test item with an error budget of e edits is split into e + 1 pieces: if the
item occurs in a document with at most e edits, at least one piece occurs
unchanged. Exact piece hits are found in one pass over each document, and
every place they point to is verified with Myers' bit-parallel edit distance.
An item too short for an error has one piece, itself, and is found where it
stands unchanged between word borders.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from outletlab.session import cut_lineage

ERROR_RATE = 0.06  # edits allowed a character of the item
BROADCAST_CHARS = 16_000_000  # characters of items searched for in one pass

_automata: dict[int, object] = {}


def normalised(text: str | None) -> str:
    """Lower case, each run of white space as one space, none at the ends."""
    return " ".join((text or "").lower().split())


def budget(item: str, rate: float = ERROR_RATE) -> int:
    return int(len(item) * rate)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(start, piece) of errors + 1 pieces of nearly equal length."""
    cuts = [len(item) * k // (errors + 1) for k in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def bordered(text: str, start: int, end: int) -> bool:
    """No word goes on over the place's start or end."""
    return not (start > 0 and text[start - 1].isalnum() and text[start].isalnum()
                or end < len(text) and text[end - 1].isalnum() and text[end].isalnum())


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        out[c] |= 1 << i
    return out


def best_end(pattern_masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(distance, end) of the best occurrence of the pattern inside the text:
    the smallest edit distance, then the earliest end. Myers' recurrence on
    vertical differences kept in one integer of m bits."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        same = pattern_masks.get(c, 0)
        vertical = same | minus
        horizontal = (((same & plus) + plus) ^ plus) | same
        up = minus | ~(horizontal | plus)
        down = plus & horizontal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up <<= 1
        down <<= 1
        plus = (down | ~(vertical | up)) & full
        minus = up & vertical & full
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """Piece automaton and masks of a set of items."""

    def __init__(self, items: list[tuple[object, str]], rate: float):
        self.items = [(key, text, budget(text, rate), masks(text)) for key, text in items]
        found: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, text, errors, _) in enumerate(self.items):
            for start, piece in pieces(text, errors):
                found[piece].append((k, start))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[object, int, int, int]]:
        """(item, distance, start, end) of the best match of each item found."""
        places: dict[int, list[int]] = defaultdict(list)
        for end, (n, owners) in self.automaton.iter(text):
            for k, start in owners:
                places[k].append(end + 1 - n - start)
        out = []
        for k, starts in places.items():
            key, item, errors, bits = self.items[k]
            m, best = len(item), (errors + 1, 0, 0)
            if not errors:
                exact = next((s for s in starts if bordered(text, s, s + m)), None)
                if exact is not None:
                    out.append((key, 0, exact, exact + m))
                continue
            for lo, hi in _windows(sorted(starts), m, errors, len(text)):
                distance, end = best_end(bits, m, text[lo:hi])
                if distance < best[0]:
                    back = text[max(lo, lo + end - m - errors): lo + end][::-1]
                    best = (distance, lo + end - best_end(masks(item[::-1]), m, back)[1], lo + end)
                if not best[0]:
                    break
            if best[0] <= errors:
                out.append((key, *best))
        return out


def _windows(starts: list[int], m: int, errors: int, n: int) -> Iterator[tuple[int, int]]:
    """Stretches of the text to verify: overlapping ones become one."""
    lo = hi = None
    for s in starts:
        a, b = max(0, s - errors), min(n, s + m + errors)
        if hi is not None and a <= hi:
            hi = max(hi, b)
            continue
        if hi is not None:
            yield lo, hi
        lo, hi = a, b
    if hi is not None:
        yield lo, hi


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", rate: float = ERROR_RATE) -> DataFrame:
    """(id, item, distance, start, end) of every document and test item found
    in it; start and end are code points of the normalised text.

    Items are sent to the tasks in parts of at most about BROADCAST_CHARS
    characters; a larger benchmark takes a pass over the documents for each
    part. Null or empty texts hold nothing and are never matched, nor are items
    without a character; items too short for an error must stand between word
    borders; null ids and repeated rows are reported as they are; of equal matches the
    earliest end counts. Empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    tests = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).filter("text IS NOT NULL")
    chars = tests.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, math.ceil(chars / BROADCAST_CHARS))
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), StructField(item_col, benchmark.schema[item_col].dataType),
                         *(StructField(c, IntegerType()) for c in ("distance", "start", "end"))])
    source = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    found = spark.createDataFrame([], schema)
    for part in range(parts):
        rows = tests.filter(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).collect()
        items = [(r.item, t) for r in rows if (t := normalised(r.text))]
        if items:
            found = found.union(source.mapInArrow(_matcher_batches(spark.sparkContext.broadcast((items, rate)), schema.names), schema))
    return found


def _matcher_batches(shared: Broadcast, names: list[str]):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = id(shared.value)
        if key not in _automata:
            _automata.clear()
            _automata[key] = (shared.value, Matcher(*shared.value))  # kept with its items, so the key stays theirs
        matcher = _automata[key][1]
        for batch in source:
            rows, out = [], []
            for i, text in enumerate(batch.column(1)):
                hits = matcher.matches(normalised(text.as_py()))
                rows += [i] * len(hits)
                out += hits
            if out:
                item, *numbers = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(item),
                                                  *(pa.array(c, pa.int32()) for c in numbers)], names=names)
    return batches


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in whose text no test item was found; a row without
    an id is known by its text. What was found is stored first, so that a small
    set is broadcast by its known size."""
    key = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.sha2(F.col(text_col).cast("string"), 256))
    named = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    hit = cut_lineage(contamination(named, benchmark, "key").select(F.col("key").alias("__hit")).distinct(), "contaminated")
    return docs.join(hit, key == F.col("__hit"), "left_anti")
