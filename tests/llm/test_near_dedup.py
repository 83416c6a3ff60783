import random
from collections import Counter, defaultdict

import numpy as np

from corpus_pipeline import near_duplicates
from outletlab.llm import common
from outletlab.llm import near_dedup as nd
from outletlab.llm.queries import QUERIES
from outletlab.session import cut_lineage
from tests.llm.conftest import SF, words


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent=85):
    """{row: (shingles, smallest id reachable)} by comparing all pairs that share a shingle."""
    sets = {k: shingles(t) for k, t in rows}
    held, shared = defaultdict(list), Counter()
    for k, s in sets.items():
        for x in s:
            held[x].append(k)
    for ids in held.values():
        for i, a in enumerate(ids):
            for b in ids[:i]:
                shared[(a, b)] += 1
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), c in shared.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {k: (len(sets[k]), find(k)) for k in sets}


def check(got, rows):
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.component_id == r.doc_id) for r in got)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op4_near_dedup"](spark, SF).collect(), rows)


def test_drifting_chain_and_star(spark):
    """Each text of a chain is close to the next only; copies of a star to the centre only."""
    rng = random.Random(3)
    rows, text = [], words(5, 300).split()
    order = list(range(60))
    rng.shuffle(order)
    for i in order:
        rows.append((i, " ".join(text)))
        text = list(text)
        text[rng.randrange(len(text))] = f"new{i}"
    centre = words(6, 400).split()
    for i in range(100, 160):
        copy = list(centre)
        for _ in range(i % 6):
            copy[rng.randrange(400)] = f"edit{i}"
        rows.append((i, " ".join(copy)))
    check(nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect(), rows)


def cloud(m, replaced):
    """Copies of one text with so many words replaced, each in its own way."""
    rng, base = random.Random(17), words(17, 300, 10_000).split()
    rows = []
    for i in range(m):
        copy = list(base)
        for at in rng.sample(range(300), rng.choice(replaced)):
            copy[at] = f"edit{i}x{at}"
        rows.append((i, " ".join(copy)))
    return rows


def test_a_group_of_texts_that_are_nearly_close(spark):
    """Most pairs of the cloud fall short of the threshold, a few reach it."""
    rows = cloud(60, (2, 3, 4, 5, 6))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for percent in (85, 80, 75):
        want = brute(rows, percent)
        assert {r.doc_id: r.component_id for r in nd.near_duplicates(docs, percent=percent).collect()} == {i: root for i, (_, root) in want.items()}


def test_pairs_met_in_a_hot_group_of_texts_that_are_not_close(spark):
    from pyspark.sql import functions as F

    m = 300
    for replaced, most in (((6, 7, 8), m * m // 6), ((8, 9, 10), m)):
        rows = cloud(m, replaced)
        texts = spark.createDataFrame(rows, "id long, text string")
        sizes = [(0, i, len(shingles(t)), i) for i, t in rows[1:]]
        posts = nd.difference_posts(spark.createDataFrame(sizes, "centre long, rep long, n long, label long"), texts, 80)
        keys = posts.filter("2 * place <= largest").groupBy("centre", "h").agg(F.count(F.lit(1)).alias("near"))
        met = posts.join(keys, ["centre", "h"]).agg(F.sum("near")).first()[0] or 0
        assert met <= most, (replaced, met)


def test_words_built_to_collide(spark):
    """A Thue-Morse word and its complement are equal to polynomial hashes modulo 2**64."""
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"one two {word} three four"), (2, f"one two {word.translate(str.maketrans('ab', 'ba'))} three four")]
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2}


def test_memory_of_a_long_text():
    import resource
    import tracemalloc

    data = np.frombuffer(("word " * 1_600_000).encode(), np.uint8)
    tracemalloc.start()
    row, value = nd.shingle_sets(data, np.array([0, len(data)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(row) == 1 and peak < 26 * len(data), (peak, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)
    assert sum(len(p) for p in common._powers.values()) <= 2 * common.CACHED_POWERS


def test_edge_rows(edge_docs, edge_rows):
    got = nd.near_duplicates(edge_docs).collect()
    assert len(got) == len(edge_rows)
    known = [r for r in edge_rows if r[0] is not None]
    want = brute(dict(known).items())
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == Counter((i, *want[i]) for i, _ in known)
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    kept = nd.near_dedup(edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(r.kept for r in got)


def test_few_steps_are_stored(spark, monkeypatch):
    """A stored step writes a file for each shuffle partition, also of a small table; a star needs no second round."""
    stored = []
    monkeypatch.setattr(nd, "cut_lineage", lambda df, name: stored.append(name) or cut_lineage(df, name))
    rows = cloud(40, (1,)) + [(100 + i, words(40 + i, 300, 10_000)) for i in range(5)]
    check(nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)
    assert len(stored) <= 20, stored
    stored.clear()
    assert nd.components(spark.createDataFrame([(500, x) for x in range(100, 160)], "a long, b long")).count() == 61
    assert len(stored) == 3, stored


def test_an_id_of_two_texts_keeps_its_rows(spark):
    """Texts of as many shingles each: a row gets the component of its own text, once."""
    a, b = words(31, 100, 10_000), words(32, 100, 10_000)
    docs = spark.createDataFrame([(3, a), (4, b), (5, a), (5, b)], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in nd.near_duplicates(docs).collect()) == [(3, 3), (4, 4), (5, 3), (5, 4)]


def test_empty(no_docs):
    assert nd.near_duplicates(no_docs).collect() == []
    assert nd.near_dedup(no_docs).collect() == []


def test_sketch_fills_every_coordinate_and_estimates_similarity():
    rng = np.random.default_rng(1)
    for n in (1, 3, 50, 3000):
        a = rng.integers(0, 1 << 62, n).astype(np.uint64)
        b = np.concatenate([a[: n - n // 5], rng.integers(0, 1 << 62, n // 5).astype(np.uint64)])
        sketch = nd.sketch_sets(np.repeat([0, 1], n), np.concatenate([a, b]), 2)
        assert (sketch != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
        want = (n - n // 5) / (n + n // 5)
        assert abs((sketch[0] == sketch[1]).mean() - want) < 0.16


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 200), (300, 200), (7, 7), (500, 100)] + [(1000, x) for x in range(1001, 1100)]
    got = {r.node: r.root for r in nd.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **dict.fromkeys((100, 200, 300, 500), 100), **{x: 1000 for x in range(1000, 1100)}}


def test_stage_links_from_080_up(spark):
    """Of 96 shingles each, 87 shared of 105 (0.829): a link of the stage, none of op4."""
    text = words(11, 100, 10_000).split()
    other = [*text[:-9], *(f"end{i}" for i in range(9))]
    rows = [(1, " ".join(text)), (2, " ".join(other)), (3, words(12, 100, 10_000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in near_duplicates(spark, docs, SF).collect()} == {1, 3}
    assert {r.doc_id for r in nd.near_dedup(docs).collect()} == {1, 2, 3}
    got = nd.near_duplicates(docs, percent=80).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 3}


def test_bands_follow_the_threshold():
    assert [nd.band_rows(p) for p in (85, 80)] == [5, 4]
    assert (1 - 0.8 ** 4) ** 30 < nd.MISSED < (1 - 0.8 ** 5) ** 24
