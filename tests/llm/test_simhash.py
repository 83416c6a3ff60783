import random

import numpy as np
import xxhash

from outletlab.llm import simhash as sh
from outletlab.llm.common import PART_BYTES
from outletlab.llm.queries import QUERIES
from outletlab.session import cut_lineage
from tests.llm.conftest import SF


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(prints, budget=4):
    """{id: smallest id reachable} over all pairs of (id, fingerprint)."""
    ids, values = zip(*prints, strict=True) if prints else ((), ())
    values = np.array(values, np.uint64)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values[:k] ^ v) <= budget):
            a, b = find(ids[k]), find(ids[j])
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op11_simhash_dedup"](spark, SF).collect()
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == dict(rows)
    want = brute(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert len(got) == len(rows) and len(set(want.values())) < len(rows)


def test_fingerprint_of_texts_in_parts():
    rng = random.Random(1)
    text = " ".join("W" * rng.randrange(1, 9) + str(rng.randrange(999)) for _ in range(3 * PART_BYTES // 8))
    assert len(text) > 2 * PART_BYTES
    assert sh.fingerprint(text.encode()) == plain_fingerprint(text)
    wide = "a b " + "x" * (PART_BYTES + 5) + " c"  # a word that is longer than a part
    assert sh.fingerprint(wide.encode()) == plain_fingerprint(wide)
    for few in ("", " \t", "one", "One two\nthree"):
        assert sh.fingerprint(few.encode()) == plain_fingerprint(few)


def test_trie_join_equals_all_pairs():
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    for flips in (2, 3, 6):
        values = np.unique(np.concatenate([[c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, flips, dtype=np.uint64)) for _ in range(150)]
                                           for c in centres]).astype(np.uint64))
        labels = sh.Labels(len(values))
        sh.trie_join(values, np.array([[0], [len(values)], [0], [len(values)], [0]], np.int64), 0, 4, labels)
        assert dict(enumerate(labels.of.tolist())) == brute(list(enumerate(values.tolist())))


def components_of(spark, values, cell):
    """Through the Spark steps below the fingerprints, with small cells."""
    rows = [(i, int(np.int64(np.uint64(v)))) for i, v in enumerate(values)]
    docs = cut_lineage(spark.createDataFrame(rows, "doc_id long, text long").repartition(3), "prints")
    before = sh._fingerprint_batches
    sh._fingerprint_batches = _given
    try:
        return {r.doc_id: r.component_id for r in sh.simhash_components(docs, cell=cell).collect()}
    finally:
        sh._fingerprint_batches = before


def _given(batches):
    import pyarrow as pa

    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([int(v.as_py()) for v in batch.column(1)], pa.int64())], names=["id", "fp"])


def test_nodes_larger_than_a_task(spark):
    """A hot group: one fingerprint, a chain drifting away from it and a cloud around it."""
    rng = np.random.default_rng(9)
    one = np.uint64(1)
    chain = [np.uint64(0x0123456789ABCDEF)]
    for k in range(40):
        chain.append(chain[-1] ^ (one << np.uint64((7 * k) % 64)) ^ (one << np.uint64((11 * k + 3) % 64)))
    cloud = [chain[0] ^ np.bitwise_or.reduce(one << rng.integers(0, 64, 6, dtype=np.uint64)) for _ in range(250)]
    loose = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    values = [int(v) for v in [*chain, *cloud, *loose, chain[0], chain[0]]]
    rng.shuffle(values)
    want = brute(list(enumerate(values)))
    assert components_of(spark, values, 16) == want
    assert components_of(spark, values, 100_000) == want


def test_edge_rows(spark, edge_rows, edge_docs, no_docs):
    got = sh.simhash_components(edge_docs).collect()
    want = [(i, plain_fingerprint(t)) for i, t in edge_rows]
    assert sorted((r.doc_id or -1, r.fp % (1 << 64)) for r in got) == sorted((i or -1, f) for i, f in want)
    known = brute([(i, f) for i, f in dict.fromkeys(want) if i is not None])
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == known
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert known[2] == 1 and known[3] == 1  # no words: fingerprint 0, linked like any other
    assert sh.simhash_components(no_docs).collect() == []


def test_an_id_with_several_texts_links_them(spark):
    docs = spark.createDataFrame([(5, "a b c d e"), (9, "a b c d e"), (9, "other words here at all"), (7, "other words here at all")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in sh.simhash_components(docs).collect()} == {(5, 5), (9, 5), (7, 5)}
