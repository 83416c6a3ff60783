"""Scores of the forests held in a larger one."""

import random
import threading
import time

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from outletlab.plans import forest_search as fos
from outletlab.session import cut_lineage


@pytest.fixture(scope="module")
def vectors(spark):
    """Rows with three numbers, a one-hot category and a plain index (a
    category of four values to the trees), and a label with noise."""
    rng = random.Random(8)
    rows = []
    for i in range(600):
        a, b, c, t = rng.random(), rng.gauss(0, 1), rng.randrange(20), rng.choice("wxyz")
        y = "hi" if a + 0.3 * b + (t in "wx") > 1 else "mid" if c > 12 else "lo"
        rows.append((i, a, b, float(c), t, y if rng.random() > 0.15 else "lo", i % 3))
    df = spark.createDataFrame(rows, "k int, a double, b double, c double, t string, y string, fold int")
    stages = [StringIndexer(inputCol="y", outputCol="label"), StringIndexer(inputCol="t", outputCol="ti"),
              OneHotEncoder(inputCol="ti", outputCol="te", dropLast=False), VectorAssembler(inputCols=["te", "ti", "a", "b", "c"], outputCol="features")]
    return cut_lineage(Pipeline(stages=stages).fit(df).transform(df).select("k", "label", "features", "fold").repartition(2, "k"), "vectors")


def accuracy(model, rows):
    evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    return evaluator.evaluate(model.transform(rows))


def test_the_whole_forest_scores_as_mllib(vectors):
    forest = RandomForestClassifier(labelCol="label", seed=5, numTrees=7, maxDepth=9, maxBins=14).fit(vectors)
    row = fos.forest_scores(forest, vectors, "label", "features", [7], [9]).first()
    assert row.validated == 600 and row.correct == round(600 * accuracy(forest, vectors))


def test_a_cut_tree_is_the_tree_of_that_depth(vectors):
    """One tree sees all rows and features, so its cuts can be fitted alone."""
    rows = vectors.filter("fold <> 1")
    fit = lambda depth: RandomForestClassifier(labelCol="label", seed=5, numTrees=1, maxDepth=depth, maxBins=16).fit(rows)
    held = {r.max_depth: r.correct for r in fos.forest_scores(fit(10), vectors, "label", "features", [1], [1, 2, 4, 7, 10]).collect()}
    assert held == {d: round(600 * accuracy(fit(d), vectors)) for d in held}
    assert len(set(held.values())) > 2


def test_first_trees_are_forests_of_their_own(spark, vectors):
    forest = RandomForestClassifier(labelCol="label", seed=5, numTrees=6, maxDepth=8).fit(vectors)
    nodes = fos.node_table(forest, spark)
    rows = vectors.select("label", "features").collect()
    leaf = nodes.leaves(8)
    x = [r.features.toArray() for r in rows]
    for k in (2, 6):
        votes = sum(tree_share(nodes, x, root, leaf) for root in nodes.roots[:k])
        want = sum(int(v.argmax()) == r.label for v, r in zip(votes, rows, strict=True))
        got = fos.forest_scores(forest, vectors, "label", "features", [2, 6], [8]).filter(F.col("num_trees") == k).first()
        assert got.correct == want


def tree_share(nodes, x, root, leaf):
    import numpy as np

    out = []
    for row in x:
        at = root
        while not leaf[at]:
            v = row[nodes.feature[at]]
            left = nodes.to_left[at, int(v)] if nodes.categorical[at] else v <= nodes.threshold[at]
            at = nodes.left[at] if left else nodes.right[at]
        out.append(nodes.share[at])
    return np.array(out)


def test_search_keeps_every_score_and_names_the_best(vectors):
    scores = fos.nested_search(vectors, "label", "features", "fold", 3, [2, 5], [3, 6], [8, 12], seed=1, parallelism=4).collect()
    assert len({(r.num_trees, r.max_depth, r.max_bins, r.fold) for r in scores}) == len(scores) == 2 * 2 * 2 * 3
    assert all(r.validated == 200 and 0 <= r.correct <= 200 for r in scores)
    mean = {}
    for r in scores:
        mean.setdefault((r.num_trees, r.max_depth, r.max_bins), []).append(r.correct / r.validated)
    best = fos.best_set(vectors.sparkSession.createDataFrame(scores))
    top = max(sum(v) / len(v) for v in mean.values())
    key = (best["numTrees"], best["maxDepth"], best["maxBins"])
    assert abs(sum(mean[key]) / 3 - top) < 1e-9
    assert key == min(k for k, v in mean.items() if abs(sum(v) / 3 - top) < 1e-9)


def test_no_validated_row_is_an_error(spark):
    with pytest.raises(ValueError, match="no row to validate"):
        fos.best_set(spark.createDataFrame([], fos.SCORES))


def test_pieces_of_a_fold_give_its_scores(vectors):
    """Rows of a fold scored in pieces, each with its forest's stored nodes."""
    rows = lambda pieces: sorted(map(tuple, fos.nested_search(vectors, "label", "features", "fold", 3, [2, 4], [3, 5], [8, 10], seed=1, pieces=pieces).collect()))
    whole = rows(1)
    assert len(whole) == 24 and rows(4) == whole


def test_a_forest_is_the_same_with_its_node_ids_cached(vectors):
    fit = lambda **more: RandomForestClassifier(labelCol="label", seed=5, numTrees=4, maxDepth=12, maxBins=9, **more).fit(vectors)
    assert fit(cacheNodeIds=True).toDebugString.split("\n")[1:] == fit().toDebugString.split("\n")[1:]


@pytest.mark.parametrize("room", [1, 2])
def test_no_more_fits_at_once_than_the_driver_has_room_for(vectors, monkeypatch, room):
    heap = vectors.sparkSession._jvm.Runtime.getRuntime().maxMemory()
    lock, running, most, fit = threading.Lock(), set(), [0], RandomForestClassifier.fit

    def counted(self, rows):
        with lock:
            running.add(self.uid)
            most[0] = max(most[0], len(running))
        try:
            return fit(self, rows)
        finally:
            running.discard(self.uid)

    monkeypatch.setattr(RandomForestClassifier, "fit", counted)
    monkeypatch.setattr(fos, "FIT_BYTES", heap // room, raising=False)
    scores = fos.nested_search(vectors, "label", "features", "fold", 3, [2], [3], [6, 8], seed=1, parallelism=6)
    assert scores.count() == 6 and most[0] <= room


def test_fits_of_many_rows_run_one_by_one(vectors, monkeypatch):
    """600 rows and 2 trees, each of which asks for a 1000th of the heap."""
    heap = vectors.sparkSession._jvm.Runtime.getRuntime().maxMemory()
    lock, running, most, fit = threading.Lock(), set(), [0], RandomForestClassifier.fit

    def counted(self, rows):
        with lock:
            running.add(self.uid)
            most[0] = max(most[0], len(running))
        try:
            return fit(self, rows)
        finally:
            running.discard(self.uid)

    monkeypatch.setattr(RandomForestClassifier, "fit", counted)
    monkeypatch.setattr(fos, "FIT_BYTES", 1)
    monkeypatch.setattr(fos, "TREE_ROW_BYTES", heap // 1000, raising=False)
    scores = fos.nested_search(vectors, "label", "features", "fold", 3, [2], [3], [6], seed=1, parallelism=3)
    assert scores.count() == 3 and most[0] == 1


def test_the_driver_is_cleared_before_each_fit(vectors, monkeypatch):
    done, fit, free = [], RandomForestClassifier.fit, getattr(fos, "free_driver", None)
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, rows: done.append("fit") or fit(self, rows))
    monkeypatch.setattr(fos, "free_driver", lambda spark: done.append("free") or free(spark), raising=False)
    fos.nested_search(vectors, "label", "features", "fold", 3, [2], [3], [6], seed=1, parallelism=1)
    assert done == ["free", "fit"] * 3


def test_fits_have_local_properties_of_their_own(vectors, monkeypatch):
    sc, fit, seen = vectors.sparkSession.sparkContext, RandomForestClassifier.fit, []

    def marked(self, rows):
        sc.setLocalProperty("fit", self.uid)
        time.sleep(0.5)
        seen.append(sc.getLocalProperty("fit") == self.uid)
        return fit(self, rows)

    monkeypatch.setattr(RandomForestClassifier, "fit", marked)
    monkeypatch.setattr(fos, "FIT_BYTES", 1, raising=False)
    fos.nested_search(vectors, "label", "features", "fold", 3, [2], [3], [6], seed=1, parallelism=3)
    assert seen == [True] * 3
