import random

import pytest

from outletlab.session import cut_lineage

SF = "/root/testdata/sf0.001"
CLASHING = ["id", "t", "n", "p", "rep", "key", "lines", "spans", "n_lines", "sequence_id", "length", "body", "kept", "score", "anchor", "place", "label"]


def words(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text): nulls, blanks, a very long text, ties, repeated rows."""
    base = words(1, 120)
    long = words(2, 60_000, 5_000)
    return [(1, None), (2, ""), (3, " \t\n "), (4, base), (5, base.replace(" ", "  ")), (6, base + " tail"), (7, base.upper()),
            (8, long), (9, long + "\n" + base), (10, "one two"), (11, "one two"), (12, "x" * 5000), (None, base), (None, "alone here"),
            (20, "same row"), (20, "same row"), (21, "Zeile äöü\n\nZeile äöü\n"), (22, "\x00\x1f 123 !!!"),
            (30, "header line of twenty chars\nown words of thirty"), (31, " Header line of twenty chars\nown words of thirty-one"),
            (32, "header line of twenty chars \nown words of thirty-two"), (33, "header line of twenty chars\nheader line of twenty chars")]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The rows with columns whose names the operators use inside."""
    rows = [(*r, *(f"{c}{i}" for c in CLASHING)) for i, r in enumerate(edge_rows)]
    return cut_lineage(spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHING)).repartition(3), "edge_docs")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
