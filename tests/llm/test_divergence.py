import re
from collections import Counter, defaultdict

from outletlab.llm import divergence as dv
from outletlab.llm.common import PART_BYTES
from outletlab.llm.queries import QUERIES
from tests.llm.conftest import SF

TERM = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return Counter(t.lower() for t in TERM.findall(text.encode()))


def brute(rows, least=30, top=50):
    """Rows (lang, source, part, item, value, rank), every share written out."""
    rows = [tuple(x or "" for x in r) for r in rows]  # (lang, source, text)
    held, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = plain_terms(text)
        held[lang].update(terms.keys())
        count[(lang, source)].update(terms)
    out = []
    groups = sorted({(lang, source) for lang, source, _ in rows})
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in held[lang].items() if n >= least)
        own = [g for g in groups if g[0] == lang]
        whole = Counter()
        for g in own:
            whole.update(count[g])

        def share(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        shares, base = {g: share(count[g]) for g in own}, share(whole)
        for g in own:
            parts = {"pair": [(o[1], sum(abs(shares[g][t] - shares[o][t]) for t in kept)) for o in own if o != g],
                     "term": [(t.decode(), shares[g][t] - base[t]) for t in kept if count[g][t] > 0 and shares[g][t] > base[t]]}
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(*g, part, item, value, i + 1) for i, (item, value) in enumerate(items) if part == "pair" or i < top]
    return sorted(out)


def test_query_equals_brute_force(spark):
    sf = SF.replace("0.001", "0.01")
    rows = [(r.lang, r.source, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op12_source_divergence"](spark, sf).collect())
    assert got == brute(rows)
    assert {r[2] for r in got} == {"pair", "term"}


def test_terms_of_texts_in_parts():
    text = "Äpfel und\x7fBirnen_x9É ß-Zz" * (PART_BYTES // 12) + "ende"
    assert dv.document_terms(text.encode()) == plain_terms(text)
    assert dv.document_terms(b"") == Counter() == dv.document_terms(b" 123\x00_{}")


def test_edge_rows(spark, edge_rows, edge_docs, no_docs):
    named = [(f"label{i}" if i % 2 else None, ["a", None, "c"][i % 3], t) for i, (_, t) in enumerate(edge_rows)]
    docs = edge_docs.selectExpr("*", "CASE WHEN substr(label, 6) % 2 = 1 THEN label END AS lang",
                                "CASE substr(label, 6) % 3 WHEN 0 THEN 'a' WHEN 2 THEN 'c' END AS source",
                                "1 AS term", "2 AS c", "3 AS df")
    got = sorted(tuple(r) for r in dv.source_divergence(docs, min_documents=2).collect())
    assert got == brute(named, least=2)
    some = sorted(tuple(r) for r in dv.source_divergence(docs, min_documents=99).collect())  # no kept term: pairs of value 0
    assert some == brute(named, least=99) and {r[4] for r in some} == {0}
    assert dv.source_divergence(no_docs.selectExpr("*", "lang AS source")).collect() == []


def test_sums_sent_in_parts(spark, monkeypatch):
    rows = [("x", f"s{i % 3}", " ".join(f"t{chr(97 + (i * j) % 26)}" for j in range(40))) for i in range(90)]
    monkeypatch.setattr(dv, "HELD_TERMS", 5)
    batches = list(dv._term_batches(iter(spark.createDataFrame(rows, "lang string, source string, text string")
                                         .selectExpr("lang", "source", "CAST(text AS BINARY)").toArrow().to_batches())))
    assert len(batches) > 5
    total, want = Counter(), Counter()
    for b in batches:
        for r in b.to_pylist():
            total[(r["lang"], r["source"], r["term"])] += r["c"]
    for lang, source, text in rows:
        for t, n in plain_terms(text).items():
            want[(lang, source, t.decode())] += n
    assert {k: n for k, n in total.items() if k[2]} == dict(want)
