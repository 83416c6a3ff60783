"""License scans: an exact set-similarity join of text blocks with templates.

Blocks are the lines of a document, as sets of words. The templates' words are
ordered by how many blocks of the whole corpus hold them, the rarest first. A
block that contains enough of a template must hold one of the template's first
words in that order (prefix filter), have enough words (length filter), and at
each shared word enough words must be left on either side (positional
filter); what remains is counted in full.

A notice wrapped over lines is a run of words that crosses line ends, at most
STRETCH times as long as the notice, outside the lines that hold the notice
alone. The same three filters apply: a run is only looked for around a prefix
word, where enough of the notice's words are in reach.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from outletlab.llm.common import bytes_hash, runs, text_blocks, word_hashes

CONTAINMENT = 0.9  # share of a template's distinct words that a block must hold
STRETCH = 2  # words a wrapped notice may take, as a multiple of its own: comment words, line numbers

# The phrases and labels of the contract.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices of public licences, (label, notice).
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
            "GNU General Public License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
]

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True


def words_of(text: str) -> list[str]:
    """A-Z lower-cased; runs of digits, letters and characters beyond ASCII."""
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text))


class Block:
    """Words of a run of rows: hash, row, place in the row, and line."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = ASCII_LOWER[data]
        self.start, self.end = runs(WORD[self.data], offsets)
        self.word = word_hashes(self.data, self.start, self.end)
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        self.n_words = np.bincount(self.row, minlength=len(offsets) - 1)
        self.place = np.arange(len(self.word)) - (np.cumsum(self.n_words) - self.n_words)[self.row]
        breaks = np.flatnonzero(self.data == 10)
        # lines are numbered through the rows; a new row starts a new line
        self.line = np.searchsorted(breaks, self.start) + self.row
        self.first_line = np.searchsorted(breaks, offsets[:-1]) + np.arange(len(offsets) - 1)

    def tokens(self, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(line, index in the sorted vocabulary) of the distinct vocabulary words of each line."""
        hit, at = self.places(vocabulary)
        pairs = np.unique(self.line[hit] * len(vocabulary) + at)
        return pairs // len(vocabulary), pairs % len(vocabulary)

    def places(self, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, index in the sorted vocabulary) of every vocabulary word, in order."""
        at = np.minimum(np.searchsorted(vocabulary, self.word), len(vocabulary) - 1)
        hit = np.flatnonzero(vocabulary[at] == self.word)
        return hit, at[hit]

    def phrase(self, words: list[str]) -> np.ndarray:
        """Indices of the words at which the phrase starts, checked byte by byte."""
        k = len(words)
        n = len(self.word) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        same = self.row[:n] == self.row[k - 1:]
        for j, w in enumerate(words):
            same &= self.word[j: n + j] == np.uint64(bytes_hash(w.encode()))
        return np.array([i for i in np.flatnonzero(same) if all(
            self.data[self.start[i + j]: self.end[i + j]].tobytes() == w.encode() for j, w in enumerate(words))], np.int64)


class Join:
    """Templates as lists of vocabulary indices, in the global order."""

    def __init__(self, templates: list[list[int]], frequency: np.ndarray, containment: float):
        rank = np.empty(len(frequency), np.int64)
        rank[np.lexsort((np.arange(len(frequency)), frequency))] = np.arange(len(frequency))
        self.rank = rank
        self.templates = [sorted(set(rank[t].tolist())) for t in templates]
        self.need = [math.ceil(containment * len(t) - 1e-9) for t in self.templates]
        self.reach = [STRETCH * len(t) for t in templates]

    def matches(self, line: np.ndarray, token: np.ndarray, words_in_line: np.ndarray) -> list[tuple[int, int, float]]:
        """(line, template, containment) of every pair that meets the threshold.
        words_in_line counts all words, an upper bound of the distinct ones."""
        rank = self.rank[token]
        order = np.lexsort((rank, line))
        line, rank = line[order], rank[order]
        out = []
        for t, (own, need) in enumerate(zip(self.templates, self.need, strict=True)):
            prefix = np.zeros(len(self.rank), bool)
            prefix[own[: len(own) - need + 1]] = True
            for x in np.unique(line[prefix[rank]]).tolist():
                if words_in_line[x] < need:
                    continue
                held = rank[slice(*np.searchsorted(line, [x, x + 1]))].tolist()
                i = j = shared = 0
                while i < len(own) and j < len(held) and shared + min(len(own) - i, len(held) - j) >= need:
                    if own[i] == held[j]:
                        shared, i, j = shared + 1, i + 1, j + 1
                    elif own[i] < held[j]:
                        i += 1
                    else:
                        j += 1
                if shared >= need:
                    out.append((x, t, shared / len(own)))
        return out

    def wrapped(self, block: Block, vocabulary: np.ndarray, alone: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
        """(line, template, containment) of every notice that crosses line
        ends; line is that of its first word. ``alone`` has the matches
        of single lines, whose words aren't looked at again."""
        word, token = block.places(vocabulary)
        rank = self.rank[token]
        out = []
        for t, (own, need, reach) in enumerate(zip(self.templates, self.need, self.reach, strict=True)):
            mine = np.zeros(len(self.rank), bool)
            mine[own] = True
            prefix = np.zeros(len(self.rank), bool)
            prefix[own[: len(own) - need + 1]] = True
            taken = np.array([x for x, u, _ in alone if u == t], np.int64)
            hit = np.flatnonzero(mine[rank])
            hit = hit[~np.isin(block.line[word[hit]], taken)]
            held, at, line = rank[hit], word[hit], block.line[word[hit]]
            spot = at + block.row[at] * reach  # words of two rows are never in reach
            rare = np.flatnonzero(prefix[held])
            low, high = np.searchsorted(spot, spot[rare] - reach, side="right"), np.searchsorted(spot, spot[rare] + reach)
            near = (high - low >= need) & (line[low] < line[high - 1])
            low, high = low[near], high[near]
            if not len(low):
                continue
            # neighbourhoods that overlap are read as one
            first = np.flatnonzero(np.append(True, low[1:] >= np.maximum.accumulate(high)[:-1]))
            for a, b in zip(low[first].tolist(), np.maximum.reduceat(high, first).tolist(), strict=True):
                out += [(x, t, share / len(own)) for x, share in _runs_held(held[a:b].tolist(), spot[a:b].tolist(), line[a:b].tolist(), need, reach)]
        return out


def _runs_held(held: list[int], spot: list[int], line: list[int], need: int, reach: int) -> list[tuple[int, int]]:
    """(line, distinct words) of the runs of at most ``reach`` words that hold
    ``need`` distinct ones over several lines; of runs that overlap the fullest."""
    out: list[tuple[int, int]] = []
    count: dict[int, int] = {}
    i, best = 0, None  # best: distinct words, first and last place of the run
    for j, w in enumerate(held):
        count[w] = count.get(w, 0) + 1
        while spot[j] - spot[i] >= reach or count[held[i]] > 1:
            count[held[i]] -= 1
            if not count[held[i]]:
                del count[held[i]]
            i += 1
        if best and i > best[2]:
            out.append((line[best[1]], best[0]))
            best = None
        if len(count) >= need and line[i] < line[j] and (not best or len(count) > best[0]):
            best = (len(count), i, j)
    if best:
        out.append((line[best[1]], best[0]))
    return out


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 templates: list[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, blocks) of every row.

    base_labels is the sorted list of labels of the phrases found; blocks
    lists every (line, label, containment) of a line and a template that it
    holds to the threshold, lines from 0, a wrapped notice by its first line. The templates are a fixed, short
    list; the words' frequencies are counted over all rows first. A null text
    counts as empty and holds nothing; null ids and repeated rows are scanned
    like any other row; an empty table gives no rows; other columns are not read.
    """
    texts = [words_of(text) for _, text in templates]
    names = sorted({w for t in texts for w in t}, key=lambda w: bytes_hash(w.encode()))
    vocabulary = np.array([bytes_hash(w.encode()) for w in names], np.uint64)
    source = docs.select(F.col(id_col), F.col(text_col).cast("string"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(1)):
                total += np.bincount(Block(data, offsets).tokens(vocabulary)[1], minlength=len(vocabulary))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["token", "n"])

    counts = source.mapInArrow(count, "token int, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    frequency = np.zeros(len(vocabulary), np.int64)
    for r in counts:
        frequency[r.token] = r.n
    index = {w: i for i, w in enumerate(names)}
    join = Join([[index[w] for w in t] for t in texts], frequency, containment)
    labels = [label for label, _ in templates]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(1)):
                n = hi - lo
                block = Block(data, offsets)
                n_base = np.zeros(n, np.int64)
                first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                base: list[set[str]] = [set() for _ in range(n)]
                for phrase, label in PHRASES.items():
                    at = block.phrase(phrase.split())
                    rows = block.row[at]
                    np.add.at(n_base, rows, 1)
                    np.minimum.at(first, rows, block.place[at])
                    np.maximum.at(last, rows, block.place[at])
                    for r in np.unique(rows).tolist():
                        base[r].add(label)
                blocks: list[list[dict]] = [[] for _ in range(n)]
                in_line = np.bincount(block.line)
                alone = join.matches(*block.tokens(vocabulary), in_line)
                for x, t, share in alone + join.wrapped(block, vocabulary, alone):
                    r = int(np.searchsorted(block.first_line, x, side="right")) - 1
                    blocks[r].append({"line": x - int(block.first_line[r]), "label": labels[t], "containment": share})
                none = n_base == 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), pa.array(block.n_words.astype(np.int64)), pa.array(n_base),
                     pa.array(first, mask=none), pa.array(last, mask=none), pa.array([sorted(b) for b in base], pa.list_(pa.string())),
                     pa.array(blocks, pa.list_(pa.struct([("line", pa.int32()), ("label", pa.string()), ("containment", pa.float64())])))],
                    names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "blocks"])

    found = StructType([StructField("line", IntegerType()), StructField("label", StringType()), StructField("containment", DoubleType())])
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType),
                         *(StructField(c, LongType()) for c in ("n_words", "n_base", "first_word", "last_word")),
                         StructField("base_labels", ArrayType(StringType())), StructField("blocks", ArrayType(found))])
    return source.mapInArrow(scan, schema)
