import random
from collections import defaultdict
from itertools import permutations

from outletlab.llm import filter_audit as fa
from outletlab.llm.common import PART_BYTES
from outletlab.llm.queries import QUERIES
from outletlab.session import scratch_path
from tests.llm.conftest import SF


def plain_mask(text):
    words = text.encode().split()
    fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
             any(c in "#$%&*|" for c in text)]
    return sum(1 << i for i, f in enumerate(fails) if f)


def brute(rows, labels):
    """{(part, order, step): counts} by applying every order to every row (id, part, text)."""
    rows = [(i, p or "", t or "") for i, p, t in rows]
    good, toxic = ({d for d, *flags in labels if flags[k] == 1 and d is not None} for k in (0, 1))
    least = {}
    for i, _, t in rows:
        key = float("inf") if i is None else i
        least[t] = min(least.get(t, key), key)
    fails = {}
    for k, (i, _, t) in enumerate(rows):
        fails[k] = plain_mask(t) | 16 * ((float("inf") if i is None else i) > least[t])
    out = {}
    for part in {p for _, p, _ in rows}:
        own = [k for k, r in enumerate(rows) if r[1] == part]
        shapley = defaultdict(int)
        for order in map("".join, permutations("ABCDE")):
            left = set(own)
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                hit = {k for k in own if fails[k] & bit}
                gone = hit & left
                left -= gone
                shapley[letter] += len(gone)
                out[(part, order, step)] = [len(left), len(gone), len(hit) - len(gone), sum(fails[k] == bit for k in own),
                                            sum(rows[k][0] in good for k in gone), sum(rows[k][0] in toxic for k in gone)]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return out


def table(rows):
    found = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in rows}
    assert len(found) == len(rows)
    return found


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    got = table(QUERIES["op13_filter_audit"](spark, SF).collect())
    assert got == brute(rows, labels)


def stored(spark, docs, parts):
    """The rows as so many files, written one after the other."""
    path = scratch_path(spark, "audit_docs")
    for frame in docs.randomSplit([1.0] * parts, 3) if parts else [docs]:
        frame.coalesce(1).write.mode("append").parquet(path)
    return path


def test_smaller_ids_that_arrive_later(spark):
    """Many copies over many micro-batches: every first holder but the last is retracted."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice(("alpha", "Beta", "x$", "y")) + str(rng.randrange(j * 40 + 1)) for _ in range(150 + 20 * j)) for j in range(6)]
    rows = [(i, f"p{rng.randrange(3)}", rng.choice(texts)) for i in range(200)]
    rows.sort(key=lambda r: -r[0])  # the largest ids first
    path = scratch_path(spark, "audit_docs")
    for lo in range(0, 200, 25):
        spark.createDataFrame(rows[lo: lo + 25], "doc_id long, source string, text string").coalesce(1).write.mode("append").parquet(path)
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 200, 2)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = fa.filter_audit(spark, path, frame, files_per_batch=1, mark_files_per_batch=1).collect()
    assert table(got) == brute(rows, labels)
    changes = fa.failure_changes(spark, path, files_per_batch=1, mark_files_per_batch=1)
    assert changes.filter("n < 0").count() >= 6  # earlier masks were taken back
    assert table(fa.filter_audit(spark, path, frame).collect()) == table(got)


def test_edge_rows(spark, edge_rows, edge_docs, no_docs):
    docs = edge_docs.selectExpr("*", "CASE substr(label, 6) % 3 WHEN 0 THEN 'a' WHEN 2 THEN 'c' END AS source", "1 AS mask", "2 AS part", "'x' AS first")
    rows = [(i, ["a", None, "c"][k % 3], t) for k, (i, t) in enumerate(edge_rows)]
    labels = [(1, 1, 0), (1, 0, 1), (5, None, 1), (None, 1, 1), (20, 1, None), (404, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("n", frame_name())
    for parts in (1, 5):
        got = fa.filter_audit(spark, stored(spark, docs, parts), frame, files_per_batch=1, mark_files_per_batch=1).collect()
        assert table(got) == brute(rows, [r for r in labels if r[0] is not None])
    empty = no_docs.selectExpr("*", "lang AS source")
    assert fa.filter_audit(spark, stored(spark, empty, 0), frame).collect() == []


def frame_name():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_masks_of_long_texts():
    for text in ("", "A" * 50, "a b " * PART_BYTES, "Wort ß# " * 300, "é" * 99 + "AA", "é" * 100 + "AA", "w " * 199 + "v", "a b " * 100):
        assert fa.failed_filters(text.encode()) == plain_mask(text)
