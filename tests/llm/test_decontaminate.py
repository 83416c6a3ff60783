import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from outletlab.llm import decontaminate as dc
from outletlab.llm.queries import QUERIES
from tests.llm.conftest import SF, words


def best_distance(pattern, text):
    """Smallest edit distance to any substring, by the full table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.text("abc ", min_size=1, max_size=20), st.text("abc ", max_size=60))
def test_myers_equals_the_table(pattern, text):
    assert dc.best_end(dc.masks(pattern), len(pattern), text)[0] == best_distance(pattern, text)


@settings(max_examples=60, deadline=None)
@given(st.text("abcd", min_size=20, max_size=60), st.randoms())
def test_every_item_within_budget_is_found(item, rng):
    errors = dc.budget(item, 0.1)
    edited = list(item)
    for _ in range(rng.randint(0, errors)):
        kind, at = rng.randrange(3), rng.randrange(len(edited))
        edited[at: at + (kind != 1)] = [] if kind == 0 else ["z"]
    text = "qq" + "".join(edited) + "rr"
    found = dc.Matcher([(7, item)], 0.1).matches(text)
    assert found and found[0][1] == best_distance(item, text)
    assert best_distance(item, text[found[0][2]: found[0][3]]) == found[0][1]


def test_query_equals_brute_force(spark):
    """All pairs by the full search where any piece of the item occurs; elsewhere none can match."""
    items = [(r.item_id, dc.normalised(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        text = dc.normalised(r.text)
        for key, item in items:
            errors = dc.budget(item)
            if any(p in text for _, p in dc.pieces(item, errors)):
                distance = dc.best_end(dc.masks(item), len(item), text)[0]
                if distance <= errors:
                    want.add((r.doc_id, key, distance))
    got = QUERIES["op7_decontaminate"](spark, SF).collect()
    assert len(got) == len(want) and {(r.doc_id, r.item_id, r.distance) for r in got} == want


def test_edited_leaks_are_caught_and_clean_documents_stay(spark):
    rng = random.Random(4)
    items = [(i, words(100 + i, 40, 5000)) for i in range(30)]
    rows = []
    for i, item in items:
        leak = list(item)
        for _ in range(dc.budget(item) // 2):
            leak[rng.randrange(len(leak))] = "#"
        rows.append((i, words(i, 300, 5000) + " " + "".join(leak).upper().replace(" ", "\n") + " " + words(i + 50, 100, 5000)))
        rows.append((1000 + i, words(2000 + i, 400, 5000)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([*items, (98, None), (99, "")], "item_id long, text string")
    assert Counter((r.doc_id, r.item_id) for r in dc.contamination(docs, bench).collect()) == Counter((i, i) for i, _ in items)
    assert {r.doc_id for r in dc.decontaminate(docs, bench).collect()} == {1000 + i for i, _ in items}


def test_short_items_stand_between_word_borders(spark):
    bench = spark.createDataFrame([(1, "Is 2+2 = 4?"), (2, "ox"), (3, " \t"), (4, "(b) yes")], "item_id long, text string")
    rows = [(1, "so: is  2+2 = 4? ok"), (2, "is 2+2 = 45?"), (3, "an OX, a fox"), (4, "foxes and boxes"), (5, "x(b) yes."), (6, "(b) yesterday"), (None, "the ox")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.start) for r in dc.contamination(docs, bench).collect()}
    assert got == {(1, 1, 4), (3, 2, 3), (5, 4, 1), (None, 2, 4)}
    assert {r.doc_id for r in dc.decontaminate(docs, bench).collect()} == {2, 4, 6}


def test_rows_without_an_id_go_by_their_text(spark):
    item = words(1, 40)
    rows = [(None, "x " + item), (None, words(2, 40)), (None, None), (7, item), (7, words(3, 40)), (8, words(4, 40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = sorted((r.doc_id or 0, r.text or "") for r in dc.decontaminate(docs, bench).collect())
    assert kept == sorted([(0, words(2, 40)), (0, ""), (8, words(4, 40))])


def test_benchmark_in_parts(spark, monkeypatch):
    bench = spark.createDataFrame([(i, words(i, 20, 3000)) for i in range(20)], "item_id long, text string")
    docs = bench.selectExpr("item_id AS doc_id", "concat('x ', text, ' y') AS text")
    monkeypatch.setattr(dc, "BROADCAST_CHARS", 500)
    assert {(r.doc_id, r.item_id) for r in dc.contamination(docs, bench).collect()} == {(i, i) for i in range(20)}


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    bench = spark.createDataFrame([(1, words(1, 120)), (2, words(1, 120)), (None, "own words of thirty-one")], "item_id long, text string")
    got = Counter((r.doc_id, r.item_id) for r in dc.contamination(edge_docs, bench).collect())
    holders = [i for i, t in edge_rows if words(1, 120) in dc.normalised(t)]
    want = Counter((i, k) for i in holders for k in (1, 2))
    want[(31, None)] += 1
    for pair in list(got):  # the two items 'thirty' and 'thirty-two' are within budget of the third
        if pair[1] is None:
            assert pair[0] in (30, 31, 32)
            got.pop(pair), want.pop(pair, None)
    assert got == want
    clean = dc.decontaminate(edge_docs, bench)
    assert clean.columns == edge_docs.columns
    assert dc.contamination(no_docs, bench).collect() == []
    assert dc.contamination(edge_docs, spark.createDataFrame([], "item_id long, text string")).collect() == []
