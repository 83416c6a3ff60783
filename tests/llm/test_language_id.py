import zlib

import numpy as np
import pytest

from outletlab.llm import language_id as li
from outletlab.llm.queries import QUERIES
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return li.fit(docs.filter(~li.held_out(docs["doc_id"])))


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text").collect()}
    got = QUERIES["op3_language_id"](spark, SF).collect()
    assert {r.doc_id for r in got} == set(truth)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    test = [r for r in got if r.held_out]
    assert sum(truth[r.doc_id].lang == r.lang_pred for r in test) >= 0.97 * len(test)


def test_edge_rows(edge_docs, edge_rows, model):
    got = li.label_languages(edge_docs, model).collect()
    assert len(got) == len(edge_rows)
    by_id = {r.doc_id: r for r in got}
    for key in (1, 2, 3):
        assert (by_id[key].lang_pred, by_id[key].score) == ("und", 0.0)
    assert all(r.lang_pred in (*model.languages, "und") for r in got)


def test_no_letters_no_model_no_rows(spark, no_docs, model):
    docs = spark.createDataFrame([(1, "123 +++ 456"), (2, "é")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in li.label_languages(docs, model).collect()}
    assert got[1] == "und" and got[2] in model.languages
    assert {r.lang_pred for r in li.label_languages(docs, None).collect()} == {"und"}
    assert li.fit(no_docs) is None
    assert li.label_languages(no_docs, None).collect() == []


def test_whole_texts_are_pooled(model):
    """The mean over windows of a long text equals the windows' own means."""
    text = np.frombuffer(("the and of in " * 400).encode() + "der die und ist ".encode() * 50, np.uint8)
    whole = li.document_probabilities(model, text, np.array([0, len(text)]))[0]
    cuts = np.append(np.arange(0, len(text), li.WINDOW), len(text))
    parts = li.document_probabilities(model, text, cuts)
    assert np.allclose(whole, (parts * np.diff(cuts)[:, None]).sum(axis=0) / len(text), atol=1e-5)
    assert np.isclose(whole.sum(), 1, atol=1e-4)


def test_gradients_move_the_loss_down():
    texts = [b"aaaa bbbb " * 6, b"cccc dddd " * 6] * 30
    model = li.train(texts, ["x", "y"] * 30)
    prob = li.document_probabilities(model, np.frombuffer(texts[0] + texts[1], np.uint8), np.array([0, 60, 120]))
    assert prob[0].argmax() == 0 and prob[1].argmax() == 1 and prob.max(axis=1).min() > 0.9
