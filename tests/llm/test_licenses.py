from outletlab.llm import licenses as lc
from outletlab.llm.queries import QUERIES
from tests.llm.conftest import SF


def brute(text):
    words = lc.words_of(text or "")
    starts, base = [], set()
    for phrase, label in lc.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        starts += at
        base |= {label} if at else set()
    labels, best = set(base), 1.0 if starts else 0.0
    for line in (text or "").split("\n"):
        held = set(lc.words_of(line))
        for label, template in lc.TEMPLATES:
            own = set(lc.words_of(template))
            share = len(own & held) / len(own)
            if share >= lc.CONTAINMENT - 1e-9:
                labels.add(label)
                best = max(best, share)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best)


def test_query_equals_brute_force(spark):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op6_license_scan"](spark, SF).collect()}
    want = {r.doc_id: brute(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert got == want


def test_scattered_words_partial_notices_and_edges(spark, tmp_path, edge_rows):
    gpl = lc.TEMPLATES[3][1]
    rows = [*(r for r in edge_rows if r[0] not in (None, 20)), (100, gpl.upper() + " " + "word " * 3000), (101, gpl.replace("version 3", "")),
            (102, gpl.replace(" ", "\n")), (103, "MIT-license, mit\nLICENSE. The Apache  License"), (104, "mitlicense mit licensed"),
            (105, "ä mit license ö"), (106, "License General Public, general public license general public license"),
            (107, "3 version License Public General GNU the under licensed is work This"), (108, "\n\n\n" + lc.TEMPLATES[5][1] + "\n" + lc.TEMPLATES[5][1])]
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op6_license_scan"](spark, path).collect()}
    assert got == {i: brute(t) for i, t in rows}
    blocks = {r.doc_id: r.blocks for r in lc.license_scan(spark.read.parquet(f"{path}/documents.parquet")).collect()}
    assert [b.line for b in blocks[108]] == [3, 4]


def test_clashing_columns_repeated_rows_and_empty(edge_docs, edge_rows, no_docs):
    assert lc.license_scan(edge_docs).count() == len(edge_rows)
    assert lc.license_scan(no_docs).collect() == []


def test_notices_wrapped_over_lines(spark, tmp_path):
    """Every notice broken into lines, with comment marks, is found with its first line and share."""
    rows, want = [], {}
    for i, (label, notice) in enumerate(lc.TEMPLATES):
        w = notice.split()
        half = len(w) // 2
        for k, text in enumerate(("/*\n * " + " ".join(w[:half]) + "\n *\n * " + " ".join(w[half:]) + "\n */", "x\n# " + "\n# ".join(w), "x\r\n" + "\r\n".join(w))):
            rows.append((10 * i + k, text))
            want[10 * i + k] = (label, 1, 1.0)
    mit, bsd = lc.TEMPLATES[1][1].split(), lc.TEMPLATES[6][1].split()
    rows += [(200, "\n".join(mit[:10])), (201, "\n".join(mit[10:])),  # halves of one notice in two rows
             (202, "\n".join(f"{w} far far" for w in bsd)), (203, "\n".join(bsd[1:])), (204, "\n".join(bsd[3:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.blocks for r in lc.license_scan(docs).collect()}
    for i, block in want.items():
        assert [(b.label, b.line, b.containment) for b in got[i]] == [block], i
    own = len(set(lc.words_of(" ".join(bsd))))
    assert [(b.label, b.containment) for b in got[203]] == [("bsd", (own - 1) / own)]
    assert got[200] == got[201] == got[202] == got[204] == []
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: (r.labels, r.score) for r in QUERIES["op6_license_scan"](spark, str(tmp_path)).collect()}
    assert all(found[i] == (label, 1.0) for i, (label, _, _) in want.items()) and found[204] == ("", 0.0)
