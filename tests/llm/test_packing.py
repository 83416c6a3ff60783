import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from outletlab.llm import packing as pk
from tests.llm.conftest import SF

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def check(rows, docs):
    """Every document in full, pieces at most a sequence long, sequences gapless."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(docs)
    for key, parts in by_doc.items():
        ids, at = ids_of(docs[key]), 0
        for n, r in enumerate(sorted(parts, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, at)
            assert n == 0 or r.length == 1024
            assert r.ids_crc32 == zlib.crc32(ids[at: at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
        assert len(parts) == -(-len(ids) // 1024)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    return len(by_sequence), -(-sum(r.length for r in rows) // 1024)


def test_round_trip_and_fill(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    used, least = check(pk.packed_documents(spark.read.parquet(f"{SF}/documents.parquet")).collect(), docs)
    assert used <= least * 1.02 + 2


def test_edge_rows(spark, edge_docs, edge_rows):
    got = pk.packed_documents(edge_docs).collect()
    assert sum(r.length for r in got) == sum(len(ids_of(t)) for _, t in edge_rows)
    unique = [r for r in edge_rows if r[0] not in (None, 20)]
    check(pk.packed_documents(edge_docs.filter("doc_id IS NOT NULL AND doc_id <> 20")).collect(), dict(unique))


def test_special_token_text_and_real_sequences(spark):
    texts = {1: "a <|endoftext|> b", 2: "plain text", 3: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    pieces = pk.token_pieces(docs)
    assert {r.id: r.ids for r in pieces.collect()} == {k: ids_of(t).tolist() for k, t in texts.items()}
    got = pk.sequences(pk.pack_pieces(pieces)).collect()
    assert sorted(x for r in got for x in r.ids) == sorted(x for t in texts.values() for x in ids_of(t).tolist())


def test_very_long_white_space(spark):
    """Runs on which the fast encoder gives up have the ids of the tokenizers file."""
    texts = {1: " " * 1_100_000, 2: "a b" + "\n" * 1_100_000 + "c <|endoftext|>", 3: "\t" * 1_100_000 + " x", 4: "short"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(pk.packed_documents(docs).collect(), texts)


def test_empty(no_docs):
    assert pk.packed_documents(no_docs).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_local_search_keeps_pieces_and_never_adds_bins(lengths):
    lengths = np.array(lengths, np.int64)
    start = pk.best_fit(lengths, 50)
    fills = lambda bins: sorted(int(lengths[b].sum()) for b in bins)
    end = pk.local_search([list(b) for b in start], lengths, 50)
    assert sorted(i for b in end for i in b) == list(range(len(lengths)))
    assert len(end) <= len(start) and max(fills(end), default=0) <= 50
    assert sum(f * f for f in fills(end)) >= sum(f * f for f in fills(start))


def test_local_search_empties_a_bin():
    lengths = np.array([6, 2, 5, 3, 4, 4])
    assert len(pk.local_search([[0], [1, 2], [3, 4], [5]], lengths, 10)) == 3
