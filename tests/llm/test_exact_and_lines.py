import hashlib
import re
from collections import Counter, defaultdict

import pytest

from outletlab.llm.exact_dedup import duplicate_groups, exact_dedup
from outletlab.llm.line_dedup import line_dedup
from outletlab.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import SF
from tests.oracle_compare import compare, duck


@pytest.mark.parametrize("key", list(ORACLE_SQL))
def test_oracle(spark, key):
    res = compare(spark, duck(SF), SF, key, QUERIES[key], ORACLE_SQL[key])
    assert res["ok"], res


def test_exact_dedup_edge_rows(edge_docs, edge_rows):
    body = lambda t: re.sub("[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in edge_rows:
        groups[body(t)].append(i)
    want = Counter()
    for i, t in edge_rows:
        ids = [x for x in groups[body(t)] if x is not None]
        keep = min(ids) if ids else None
        want[(i, keep, len(groups[body(t)]), i == keep, hashlib.sha256(body(t).encode()).hexdigest())] += 1
    got = exact_dedup(edge_docs).collect()
    assert Counter(tuple(r) for r in got) == want


def test_exact_dedup_plan_is_native(edge_docs):
    plan = exact_dedup(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_exact_dedup_empty(no_docs):
    assert exact_dedup(no_docs).collect() == []
    assert duplicate_groups(no_docs).collect() == []


def clean_lines(rows, min_chars=20, min_docs=3):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            held[k].append(i)
    gone = {k: max((i for i in ids if i is not None), default=None) for k, ids in held.items() if len(k) >= min_chars and len(ids) >= min_docs}
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in gone or gone[key(x)] == i]
        out[(i, "\n".join(kept), len(lines), len(lines) - len(kept))] += 1
    return out


def test_line_dedup_edge_rows(edge_docs, edge_rows):
    got = line_dedup(edge_docs)
    assert got.columns == [c for c in edge_docs.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == clean_lines(edge_rows)


def test_line_dedup_thresholds(spark):
    rows = [(i, f"{'a' * 19}\n{'B' * 20}\nrow {i}\n{'b' * 20}") for i in range(5)] + [(9, "c" * 30), (8, "c" * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in line_dedup(docs).collect()) == clean_lines(rows)


def test_line_dedup_empty_and_native(no_docs, edge_docs):
    assert line_dedup(no_docs).collect() == []
    plan = line_dedup(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
