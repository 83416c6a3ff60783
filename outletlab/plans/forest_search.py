"""Nested search of forest parameters.

A forest of the largest tree count and depth holds the smaller ones: its first
k trees are a forest of k trees, and a tree cut at depth d, where a node's own
class counts decide, is a tree of that depth. So one fit for each fold and bin
count scores every tree count and depth, where fitting each set anew would take
trees x depths as many. The cut trees are pruned as MLlib prunes (two leaves
that predict the same class become one).

The fits run beside one another and only store their forests: rows of a fold
meet the stored nodes of its forests in one grouped job, so the driver keeps
the scores alone.
"""

from __future__ import annotations

from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outletlab.plans.forest_growth import grown_forest, grown_scores
from outletlab.session import free_driver, scratch_path

SCORES = "num_trees int, max_depth int, max_bins int, fold int, correct long, validated long"
NODES = ["treeID", "nodeData.id", "nodeData.prediction", "nodeData.impurityStats", "nodeData.leftChild", "nodeData.rightChild",
         "nodeData.split.featureIndex AS feature", "nodeData.split.leftCategoriesOrThreshold AS split_values", "nodeData.split.numCategories AS arity"]

FIT_BYTES = 256 << 20  # of the driver's heap for one fit beside others, at least
FIT_ROWS = 10_000  # most rows of a search whose forests MLlib fits
TREE_ROW_BYTES = 1 << 10  # of it for each row of each tree: deep trees have nodes in proportion to their rows


class NodeTable:
    """The nodes of a forest as arrays, tree after tree, and each tree's root."""

    def __init__(self, nodes: pa.Table):
        nodes = nodes.sort_by([("treeID", "ascending"), ("id", "ascending")]).combine_chunks()
        column = lambda c: nodes.column(c).to_numpy()
        self.roots = np.flatnonzero(column("id") == 0)
        first = np.repeat(self.roots, np.diff([*self.roots, len(nodes)]))
        left, right = column("leftChild"), column("rightChild")
        self.inner = left >= 0
        self.left, self.right = np.where(self.inner, first + left, 0), np.where(self.inner, first + right, 0)
        self.prediction = column("prediction")
        counts = pc.list_flatten(nodes.column("impurityStats")).to_numpy().reshape(len(nodes), -1)
        self.share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1e-300)
        self.feature = np.maximum(column("feature"), 0)
        self.categorical = self.inner & (column("arity") >= 0)
        values = pc.list_flatten(nodes.column("split_values")).to_numpy()
        node = np.repeat(np.arange(len(nodes)), pc.list_value_length(nodes.column("split_values")).to_numpy())
        self.threshold, self.to_left = np.zeros(len(nodes)), np.zeros((len(nodes), max(1, column("arity").max())), bool)
        number = (self.inner & ~self.categorical)[node]
        self.threshold[node[number]] = values[number]
        listed = self.categorical[node]
        self.to_left[node[listed], values[listed].astype(int)] = True
        self._measure()

    def _measure(self) -> None:
        self.depth = np.zeros(len(self.inner), int)
        level = self.roots
        while len(level):
            level = level[self.inner[level]]
            self.depth[self.left[level]] = self.depth[self.right[level]] = self.depth[level] + 1
            level = np.concatenate([self.left[level], self.right[level]])

    @classmethod
    def grown(cls, trees: list) -> NodeTable:
        """Of trees of ``forest_growth``; their rows are bins."""
        self = cls.__new__(cls)
        sizes = [len(t["left"]) for t in trees]
        self.roots = np.cumsum([0, *sizes[:-1]])
        joined = lambda c: np.concatenate([t[c] for t in trees])
        first, left, right, counts = np.repeat(self.roots, sizes), joined("left"), joined("right"), joined("counts")
        self.inner = left >= 0
        self.left, self.right = np.where(self.inner, first + left, 0), np.where(self.inner, first + right, 0)
        self.prediction, self.share = counts.argmax(axis=1), counts / counts.sum(axis=1, keepdims=True)
        self.feature, self.threshold = joined("feature"), joined("last")
        self.categorical, self.to_left = np.zeros(len(left), bool), np.zeros((len(left), 1), bool)
        self._measure()
        return self

    def leaves(self, depth: int) -> np.ndarray:
        """Which nodes are leaves when the trees are cut at ``depth``."""
        leaf = ~self.inner | (self.depth >= depth)
        for level in range(depth - 1, -1, -1):
            node = np.flatnonzero((self.depth == level) & ~leaf)
            a, b = self.left[node], self.right[node]
            leaf[node] = leaf[a] & leaf[b] & (self.prediction[a] == self.prediction[b])
        return leaf

    def walk(self, x: np.ndarray, at: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """The leaf that each row of ``x`` comes to from its node in ``at``."""
        at = at.copy()
        rows = np.flatnonzero(~leaf[at])
        listed = self.categorical.any()
        while len(rows):
            node = at[rows]
            value = x[rows, self.feature[node]]
            left = value <= self.threshold[node]
            if listed:
                known = np.where(self.categorical[node], value, 0).astype(int)
                left = np.where(self.categorical[node], self.to_left[node, np.minimum(known, self.to_left.shape[1] - 1)], left)
            at[rows] = np.where(left, self.left[node], self.right[node])
            rows = rows[~leaf[at[rows]]]
        return at

    def correct(self, x: np.ndarray, y: np.ndarray, num_trees: list, max_depth: list) -> dict:
        """{(trees, depth): rows whose class gets the largest total share}. A
        leaf of the trees cut at some depth is above or at that of a later cut,
        so a row goes on from where it was."""
        out, depths = {}, sorted(set(max_depth))
        leaves, votes = [self.leaves(d) for d in depths], [np.zeros((len(x), self.share.shape[1])) for _ in depths]
        for t, root in enumerate(self.roots, 1):
            at = np.full(len(x), root)
            for depth, leaf, vote in zip(depths, leaves, votes, strict=True):
                at = self.walk(x, at, leaf)
                vote += self.share[at]
                if t in num_trees:
                    out[(t, depth)] = int((vote.argmax(axis=1) == y).sum())
        return out


def node_table(forest: RandomForestClassificationModel, spark) -> NodeTable:
    """Of a fitted forest, through its saved form; for a look at a single one."""
    return NodeTable(_saved(forest, spark).toArrow())


def _saved(forest: RandomForestClassificationModel, spark) -> DataFrame:
    path = scratch_path(spark, "forest")
    forest.write().save(path)
    return spark.read.parquet(f"{path}/data").selectExpr(*NODES)


def stored_scores(nodes: DataFrame, rows: DataFrame, label: str, features: str, num_trees: list, max_depth: list,
                  by: tuple = (), pieces: int = 1) -> DataFrame:
    """(by, num_trees, max_depth, correct, validated) for every forest held in
    one of ``nodes``, on the rows that agree with it in ``by``. A forest's rows
    are dealt into ``pieces``; a task holds one forest and one piece."""

    def scored(key: tuple, rows: pa.Table, nodes: pa.Table) -> pa.Table:
        found: dict = {}
        if len(rows):
            if not len(nodes):
                raise ValueError(f"no forest stored for {key}")
            x = pc.list_flatten(rows.column("x")).to_numpy().reshape(len(rows), -1)
            found = NodeTable(nodes).correct(x, rows.column("y").to_numpy(), num_trees, max_depth)
        trees, depth = zip(*found, strict=True) if found else ((), ())
        n = len(found)
        return pa.table([*[pa.array([k.as_py()] * n, pa.int32()) for k in key[:-1]], pa.array(trees, pa.int32()), pa.array(depth, pa.int32()),
                         pa.array(found.values(), pa.int64()), pa.array([len(rows)] * n, pa.int64())], names=columns)

    columns = [*by, "num_trees", "max_depth", "correct", "validated"]
    types = dict(zip(columns, ["int"] * (len(by) + 2) + ["long"] * 2, strict=True))
    dealt = rows.select(*by, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(pieces)).alias("piece"),
                        F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x"))
    every = nodes.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pieces - 1).cast("long"))))
    keys = (*by, "piece")
    scores = dealt.groupBy(*keys).cogroup(every.groupBy(*keys)).applyInArrow(scored, ", ".join(f"{c} {t}" for c, t in types.items()))
    return scores.groupBy(*columns[:-2]).agg(F.sum("correct").alias("correct"), F.sum("validated").alias("validated"))


def forest_scores(forest: RandomForestClassificationModel, rows: DataFrame, label: str, features: str,
                  num_trees: list, max_depth: list) -> DataFrame:
    """(num_trees, max_depth, correct, validated) on ``rows`` for every forest
    held in this one."""
    return stored_scores(_saved(forest, rows.sparkSession), rows, label, features, num_trees, max_depth)


def fits_at_once(spark, rows: int = 0, trees: int = 0) -> int:
    """As many as the driver's heap has room for: a fit of ``trees`` on
    ``rows`` keeps its trees there, and what its levels send back."""
    return max(1, spark._jvm.Runtime.getRuntime().maxMemory() // max(FIT_BYTES, rows * trees * TREE_ROW_BYTES))


def _listed(rows: DataFrame, features: str) -> bool:
    """Whether a feature is a list of more than two categories, by its name tag."""
    return bool(rows.schema[features].metadata.get("ml_attr", {}).get("attrs", {}).get("nominal"))


def nested_search(rows: DataFrame, label: str, features: str, fold: str, folds: int, num_trees: list, max_depth: list,
                  max_bins: list, seed: int, parallelism: int = 8, pieces: int = 1) -> DataFrame:
    """One row a (num_trees, max_depth, max_bins, fold): how many rows of the
    fold the forest fitted on the other folds gets right. Folds without rows
    give none. As many rows as sets x folds. Up to FIT_ROWS rows MLlib fits the
    forests, and a fold's rows are scored in ``pieces``; more rows have them
    grown on the executors."""
    spark, total = rows.sparkSession, rows.count()
    if total > FIT_ROWS and not _listed(rows, features):
        return grown_scores(rows, label, features, fold, folds, num_trees, max_depth, max_bins, seed, SCORES)
    root = scratch_path(spark, "forests")
    jobs = [(bins, k) for bins in max_bins for k in range(folds)]

    def one(job: tuple) -> str:
        bins, k = job
        free_driver(spark)  # of what the fit before left
        forest = RandomForestClassifier(labelCol=label, featuresCol=features, seed=seed, numTrees=max(num_trees), maxDepth=max(max_depth),
                                        maxBins=bins, cacheNodeIds=True).fit(rows.filter(F.col(fold) != k))
        forest.write().save(f"{root}/max_bins={bins}/fold={k}")
        return f"{root}/max_bins={bins}/fold={k}/data"

    with ThreadPool(min(parallelism, len(jobs), fits_at_once(spark, total, max(num_trees)))) as pool:
        # wrapped one by one: threads under one wrapper share Spark's local properties, and with them the number of the running query
        fits = [inheritable_thread_target(spark)(partial(one, job)) for job in jobs]
        paths = pool.map(lambda fit: fit(), fits, chunksize=1)
    nodes = spark.read.option("basePath", root).parquet(*paths).selectExpr("max_bins", "fold", *NODES)
    held = rows.select(F.explode(F.array(*[F.lit(b) for b in max_bins])).alias("max_bins"), F.col(fold).cast("int").alias("fold"), label, features)
    scores = stored_scores(nodes, held, label, features, num_trees, max_depth, ("max_bins", "fold"), pieces)
    return scores.select(*[c.split()[0] for c in SCORES.split(", ")])


def fit_forest(estimator: RandomForestClassifier, rows: DataFrame) -> RandomForestClassificationModel:
    """The forest of ``estimator``: fitted by MLlib up to FIT_ROWS rows, of
    more rows grown on the executors."""
    if rows.count() > FIT_ROWS and not _listed(rows, estimator.getFeaturesCol()):
        return grown_forest(estimator, rows, scratch_path(rows.sparkSession, "grown_forest"))
    return estimator.fit(rows)


def best_set(scores: DataFrame) -> dict:
    """The set of the largest mean accuracy over the folds; of equal ones the
    smallest tree count, depth and bin count."""
    mean = scores.groupBy("num_trees", "max_depth", "max_bins").agg(F.avg(F.col("correct") / F.col("validated")).alias("accuracy"))
    best = mean.orderBy(F.round("accuracy", 12).desc(), "num_trees", "max_depth", "max_bins").first()
    if best is None:
        raise ValueError("no row to validate the parameter sets on")
    return {"numTrees": best.num_trees, "maxDepth": best.max_depth, "maxBins": best.max_bins}
