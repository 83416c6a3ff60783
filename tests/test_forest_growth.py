"""Forests grown on the executors."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

from outletlab.plans import forest_growth as fg
from outletlab.plans import forest_search as fos
from outletlab.plans import model as mo
from outletlab.session import cut_lineage, scratch_path

ROWS = 900


@pytest.fixture(scope="module")
def fitted(spark):
    rng = random.Random(8)
    rows = []
    for i in range(ROWS):
        a, b, c, t = rng.random(), rng.gauss(0, 1), rng.randrange(20), rng.choice("wxyz")
        y = "hi" if a + 0.3 * b + (t in "wx") > 1 else "mid" if c > 12 else "lo"
        rows.append((i, a, b, float(c), 7.0, t, y if rng.random() > 0.15 else "lo", i % 3))
    df = spark.createDataFrame(rows, "k int, a double, b double, c double, same double, t string, y string, fold int")
    stages = [StringIndexer(inputCol="y", outputCol="label"), StringIndexer(inputCol="t", outputCol="ti"),
              OneHotEncoder(inputCol="ti", outputCol="te", dropLast=False), VectorAssembler(inputCols=["te", "a", "b", "c", "same"], outputCol="features")]
    pipeline = Pipeline(stages=stages).fit(df)
    return pipeline, df, cut_lineage(pipeline.transform(df).select("k", "label", "features", "fold").repartition(3, "k"), "vectors")


@pytest.fixture(scope="module")
def vectors(fitted):
    return fitted[2]


@pytest.fixture
def large(monkeypatch):
    """So few rows are many."""
    monkeypatch.setattr(fos, "FIT_ROWS", 100, raising=False)


def arrays(vectors):
    rows = vectors.collect()
    return np.array([r.features.toArray() for r in rows]), np.array([int(r.label) for r in rows])


def accuracy(model, rows):
    return MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy").evaluate(model.transform(rows))


@pytest.mark.parametrize("max_bins, max_depth", [(6, 3), (6, 20), (16, 8), (32, 20)])
def test_a_tree_without_draws_is_mllibs(spark, vectors, max_bins, max_depth):
    forest = RandomForestClassifier(labelCol="label", numTrees=1, maxDepth=max_depth, maxBins=max_bins, bootstrap=False, featureSubsetStrategy="all").fit(vectors)
    want = fos.node_table(forest, spark)
    x, y = arrays(vectors)
    points = [fg.split_points(*np.unique(column, return_counts=True), max_bins - 1) for column in x.T]
    bins = np.stack([np.searchsorted(p, v) for p, v in zip(points, x.T, strict=True)], axis=1).astype(np.uint8)
    tree = fg.grow_tree(bins, y, np.ones(len(y), int), 3, max_bins, max_depth, lambda n: np.broadcast_to(np.arange(x.shape[1]), (n, x.shape[1])))
    got = fos.NodeTable.grown([tree])
    leaf, pairs, met = got.leaves(max_depth), [(0, 0)], 0
    while pairs:
        i, j = pairs.pop()
        met += 1
        assert want.inner[i] == (not leaf[j]) and want.prediction[i] == got.prediction[j] and (want.share[i] == got.share[j]).all()
        if want.inner[i]:
            assert want.feature[i] == got.feature[j] and (want.categorical[i] or want.threshold[i] == points[got.feature[j]][got.threshold[j]])
            pairs += [(want.left[i], got.left[j]), (want.right[i], got.right[j])]
    assert met == len(want.inner)


def test_no_forest_of_many_rows_is_fitted_from_the_driver(vectors, large, monkeypatch):
    def fit(self, rows):
        raise AssertionError("grown level by level from the driver")

    monkeypatch.setattr(RandomForestClassifier, "fit", fit)
    search = lambda: sorted(map(tuple, fos.nested_search(vectors, "label", "features", "fold", 3, [2, 5], [3, 6], [8, 12], seed=1).collect()))
    scores = search()
    assert len({s[:4] for s in scores}) == len(scores) == 2 * 2 * 2 * 3
    assert all(validated == ROWS / 3 and 0 < correct <= validated for *_, correct, validated in scores)
    assert search() == scores


def test_grown_forests_are_as_good_as_mllibs(vectors, monkeypatch):
    def mean():
        rows = fos.nested_search(vectors, "label", "features", "fold", 3, [15], [3, 10], [16], seed=1).collect()
        return [sum(r.correct for r in rows if r.max_depth == d) / ROWS for d in (3, 10)]

    fitted = mean()
    monkeypatch.setattr(fos, "FIT_ROWS", 100, raising=False)
    assert all(abs(a - b) < 0.05 for a, b in zip(fitted, mean(), strict=True))


def test_search_scores_the_forest_that_is_grown(vectors, large):
    scores = {(r.num_trees, r.max_depth, r.fold): r.correct for r in
              fos.nested_search(vectors, "label", "features", "fold", 3, [3, 8], [4, 9], [10], seed=7).collect()}
    estimator = RandomForestClassifier(labelCol="label", numTrees=8, maxDepth=9, maxBins=10, seed=7)
    for k in range(3):
        forest = fos.fit_forest(estimator, vectors.filter(f"fold <> {k}"))
        assert round(accuracy(forest, vectors.filter(f"fold = {k}")) * ROWS / 3) == scores[(8, 9, k)]


def test_a_grown_forest_is_a_model_of_mllib(spark, fitted, large):
    pipeline, df, vectors = fitted
    estimator = RandomForestClassifier(labelCol="label", numTrees=6, maxDepth=7, maxBins=12, seed=3, cacheNodeIds=True)
    forest = fos.fit_forest(estimator, vectors)
    assert (forest.getNumTrees, forest.numClasses, forest.numFeatures) == (6, 3, 8)
    assert (forest.getMaxDepth(), forest.getMaxBins(), forest.getSeed(), forest.uid) == (7, 12, 3, estimator.uid)
    assert abs(sum(forest.featureImportances.toArray()) - 1) < 1e-9 and forest.featureImportances[7] == 0
    assert abs(accuracy(forest, vectors) - accuracy(estimator.fit(vectors), vectors)) < 0.05
    nodes = fos.node_table(forest, spark)
    assert nodes.categorical.any() and nodes.depth.max() <= 7 and len(nodes.inner) == forest.totalNumNodes
    row = fos.forest_scores(forest, vectors, "label", "features", [6], [7]).first()
    assert row.correct == round(ROWS * accuracy(forest, vectors))

    model, root = PipelineModel(stages=[*pipeline.stages, forest]), scratch_path(spark, "grown")
    for _ in range(2):  # the second overwrites the first
        mo.save_model(model, vectors, f"{root}/artifacts", f"{root}/data")
    loaded = mo.load_model(f"{root}/artifacts")
    scored = lambda m: [(r.k, r.prediction, r.probability) for r in m.transform(df).select("k", "prediction", "probability").orderBy("k").collect()]
    assert scored(loaded) == scored(model) and len(scored(model)) == ROWS


def test_a_fold_with_all_rows_is_an_error(vectors, large):
    rows = vectors.selectExpr("label", "features", "1 AS fold")
    with pytest.raises(Exception, match="no row to fit on beside fold 1"):
        fos.nested_search(rows, "label", "features", "fold", 2, [2], [3], [8], seed=1).collect()
