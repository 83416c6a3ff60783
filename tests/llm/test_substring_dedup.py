import hashlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from outletlab.llm import substring_dedup as sd
from outletlab.llm.queries import QUERIES
from tests.llm.conftest import SF, words


def brute(rows):
    """{(id, text): (bytes, spans, rest)} by counting every 200-byte string."""
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + 200] for b in texts for i in range(len(b) - 199))
    out = []
    for (key, _), b in zip(rows, texts, strict=True):
        gone, reach = bytearray(len(b)), 0
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[max(i, reach): i + 200] = b"\x01" * (i + 200 - max(i, reach))
                reach = i + 200
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((key, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return Counter(out)


def result(frame):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in frame.collect())


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op9_substring_dedup"](spark, SF).collect())
    assert got == brute(rows)


def overlapping(spark):
    passage, other = words(1, 60), words(2, 70)
    rows = [(i, words(10 + i, 40) + passage[: 190 + i] + words(40 + i, 30) + (other if i % 3 else other[5:]) + "é" * i) for i in range(24)]
    rows += [(50, "ab" * 300), (51, "x" * 199), (52, "y" * 200), (53, "y" * 201), (54, "z" * 400 + "z" * 10), (55, "ü" * 150)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_overlaps_runs_and_multibyte(spark):
    rows, docs = overlapping(spark)
    assert result(sd.remove_repeats(docs)) == brute(rows)


def test_hot_anchors_dealt_by_whole_strings(spark, monkeypatch):
    rows, docs = overlapping(spark)
    monkeypatch.setattr(sd, "HOT_SEGMENTS", 2)
    assert result(sd.remove_repeats(docs)) == brute(rows)


def test_small_blocks(spark, monkeypatch):
    rows, docs = overlapping(spark)
    monkeypatch.setattr(sd, "BLOCK_BYTES", 2000)
    assert result(sd.remove_repeats(docs)) == brute(rows)


def test_edge_rows(edge_docs, edge_rows, no_docs):
    assert result(sd.remove_repeats(edge_docs)) == brute(edge_rows)
    assert sd.remove_repeats(no_docs).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([b"abc", b"ab", b"aaaaaaaaaa", b"\xff", b"abcabcabc"]), min_size=1, max_size=40))
def test_index_gives_the_longest_other_match(parts):
    text = b"".join(parts)
    index = sd.RunLengthIndex(np.frombuffer(text, np.uint8))
    order = sorted(range(len(text)), key=lambda i: text[i:])
    assert index.order.tolist() == order

    def common(i, j):
        k = 0
        while max(i, j) + k < len(text) and text[i + k] == text[j + k]:
            k += 1
        return k

    want = [max((common(i, j) for j in range(len(text)) if j != i), default=0) for i in range(len(text))]
    assert index.matching_statistics().tolist() == want
    runs = np.diff(np.append(index.run_start, len(text)))
    assert np.repeat(index.run_symbol, runs).tolist() == [text[i - 1] for i in order]
    assert index.last_sample.tolist() == [order[e - 1] for e in np.cumsum(runs)]


def test_segments_hold_every_string_once():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    offsets = np.array([0, 150, 1200, 1399, 1400, 1600, 5000])
    start, count, _, _ = sd.segments(data, offsets)
    strings = sorted(s + k for s, n in zip(start.tolist(), count.tolist(), strict=True) for k in range(n))
    assert strings == [i for a, b in zip(offsets[:-1], offsets[1:], strict=True) for i in range(a, b - 199)]
    assert count.max() < 256
