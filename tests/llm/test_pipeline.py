import re

import corpus_pipeline as cp
from outletlab.llm import decontaminate as dc
from outletlab.session import cut_lineage
from tests.llm.conftest import SF
from tests.llm.test_exact_and_lines import clean_lines
from tests.llm.test_near_dedup import brute as near_brute
from tests.llm.test_packing import check as packing_check


def test_every_stage_equals_brute_force(spark):
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    items = [dc.normalised(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in cp.STAGES:
        docs = cut_lineage(stage(spark, docs, SF), f"test_{name}")
        if name == "packing":
            packing_check(docs.collect(), rows)
            break
        assert docs.columns == columns
        if name == "language_id":
            want = {k: t for k, t in rows.items() if re.search(r"[^\W\d_]", t or "")}
        elif name == "line_dedup":
            want = {i: text for i, text, _, _ in clean_lines(rows.items())}
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        elif name == "near_dedup":
            want = {k: rows[k] for k, (_, root) in near_brute(rows.items(), cp.NEAR_PERCENT).items() if k == root}
        else:
            want = {k: t for k, t in rows.items() if not any(
                dc.best_end(dc.masks(i), len(i), dc.normalised(t))[0] <= dc.budget(i)
                for i in items if any(p in dc.normalised(t) for _, p in dc.pieces(i, dc.budget(i))))}
            assert len(want) < len(rows)
        rows = {r.doc_id: r.text for r in docs.collect()}
        assert rows == want


def test_a_foreign_text_goes_by_its_score(spark):
    """The model knows four languages, so the best one's mean probability can't fall below 0.25."""
    greek = "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα."
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    with_foreign = docs.unionByName(spark.createDataFrame([(10 ** 9, greek, None, "src0", len(greek))], docs.schema))
    kept = {r.doc_id for r in cp.language_id(spark, with_foreign, SF).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.filter("text RLIKE '[^\\\\W\\\\d_]'").collect()}


def test_edge_rows_pass_every_stage(spark, edge_docs, no_docs):
    for source in (edge_docs.withColumn("lang", edge_docs["label"]), no_docs):
        docs = source
        for name, stage in cp.STAGES:
            docs = cut_lineage(stage(spark, docs, SF), f"edge_{name}")
            assert name == "packing" or docs.columns == source.columns
