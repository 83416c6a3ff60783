"""Forests grown on the executors, a forest in a task.

MLlib grows a forest from the driver: for each level every partition deals out
a dense histogram of every node, and the driver keeps the nodes. Trees as deep
as the search asks for have nodes in proportion to their rows, so beyond some
ten thousand rows the histograms outweigh the rows many times over. Here the
rows come, as one byte a feature, to a task for each forest of the search. It
grows the trees with histograms of the values that a node holds, scores the
rows held out, and sends the scores alone.

The rules are MLlib's: its split points (of all rows, where MLlib takes them
from 10,000 drawn ones), the Gini gain, Poisson weights for the rows of a tree,
a new draw of sqrt(features) for each node, the first of equal gains, and a leaf
where no gain or one class is left. The draws come from numpy's generator. A
tree without draws is MLlib's tree (tested).
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark
from pyspark import TaskContext
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPSILON = 2.0**-52  # an impurity below it is none
VALUES = "feature int, value double, fold int, n long"
POINTS = "feature int, max_bins int, fold int, points array<double>"
BLOCKS = "job int, part int, at long, bins binary, label binary, fold binary"


def split_points(values: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` points between the distinct ``values`` (ascending):
    all, or where the running count comes closest to multiples of a stride."""
    if len(values) - 1 <= most:
        return (values[:-1] + values[1:]) / 2
    seen = np.cumsum(counts)
    both = seen[:-1] + seen[1:]  # the point after i is closest to a target once both[i] exceeds it twice
    stride = seen[-1] / (most + 1)
    found, at, target = [], 0, stride
    while (at := max(at, int(np.searchsorted(both, 2 * target, side="right")))) < len(both):
        found.append(at)
        at, target = at + 1, target + stride
    return (values[found] + values[np.array(found, int) + 1]) / 2


def gini(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    out = np.ones(len(counts))
    for c in range(counts.shape[1]):
        share = counts[:, c] / total
        out -= share * share
    return out


def grow_tree(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, classes: int, most_bins: int, max_depth: int,
              draw: Callable[[int], np.ndarray]) -> dict:
    """One tree over ``bins`` (rows x features) as arrays by node, level after
    level: feature and last bin that goes left, children (-1: none) and class
    counts. ``draw(n)`` gives the features of each of n nodes."""
    width, flat = bins.shape[1], bins.reshape(-1)
    rows = np.flatnonzero(weight)
    first, label, weight = rows * width, label[rows], weight[rows].astype(float)
    slot = np.zeros(len(rows), np.int64)
    counts = np.bincount(label, weight, classes).reshape(1, classes)
    size, ids = 1, np.zeros(1, np.int64)
    every, grown = [counts], []
    for depth in range(max_depth):
        if not len(ids):
            break
        total = counts.sum(axis=1)
        impurity = gini(counts, total)
        before = np.cumsum(counts, axis=0) - counts
        features = draw(len(ids))
        best, feature, last, to_left = np.zeros(len(ids)), np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), np.zeros_like(counts)
        rank = np.zeros(len(ids) * most_bins, np.int64)
        for f in features.T:
            cell = slot * most_bins + flat[first + f[slot]]
            held = np.flatnonzero(np.bincount(cell, minlength=len(rank)))
            rank[held] = np.arange(len(held))
            node = held // most_bins
            left = np.cumsum(np.bincount(rank[cell] * classes + label, weight, len(held) * classes).reshape(-1, classes), axis=0) - before[node]
            n_left = left.sum(axis=1)
            some = np.flatnonzero(total[node] > n_left)  # not the last bin of a node: nothing is right of it
            if not len(some):
                continue
            node, left, n_left, held = node[some], left[some], n_left[some], held[some]
            all_n, right = total[node], counts[node] - left
            n_right = all_n - n_left
            gain = impurity[node] - n_left / all_n * gini(left, n_left) - n_right / all_n * gini(right, n_right)
            begin = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            top = np.flatnonzero(gain == np.repeat(np.maximum.reduceat(gain, begin), np.diff(np.r_[begin, len(node)])))
            top = top[np.r_[True, node[top][1:] != node[top][:-1]]]
            top = top[gain[top] > best[node[top]]]
            at = node[top]
            best[at], feature[at], last[at], to_left[at] = gain[top], f[at], held[top] % most_bins, left[top]
        split = best > 0
        children = np.stack([to_left[split], counts[split] - to_left[split]], axis=1).reshape(-1, classes)
        born = size + np.arange(len(children))
        grown.append((ids[split], feature[split], last[split], born[::2]))
        every.append(children)
        size += len(children)
        goes_on = gini(children, children.sum(axis=1)) >= EPSILON
        place = np.where(goes_on, np.cumsum(goes_on) - 1, -1)
        to = np.where(split, 2 * (np.cumsum(split) - 1), 0)[slot] + (flat[first + feature[slot]] > last[slot])
        kept = np.flatnonzero(split[slot])
        kept = kept[place[to[kept]] >= 0]
        slot, first, label, weight = place[to[kept]], first[kept], label[kept], weight[kept]
        ids, counts = born[goes_on], children[goes_on]
    out = {"counts": np.concatenate(every), **{c: np.full(size, v) for c, v in (("feature", 0), ("last", 0), ("left", -1), ("right", -1))}}
    for at, f, b, left in grown:
        out["feature"][at], out["last"][at], out["left"][at], out["right"][at] = f, b, left, left + 1
    return out


def grow_drawn(bins: np.ndarray, label: np.ndarray, classes: int, most_bins: int, tree: int, num_trees: int, max_depth: int, seed: int) -> dict:
    """A tree of a forest of ``num_trees``, with its draws of rows and features."""
    width = bins.shape[1]
    wanted = math.ceil(math.sqrt(width)) if num_trees > 1 else width
    rng = np.random.default_rng([seed, tree])

    def draw(n: int) -> np.ndarray:
        if wanted == width:
            return np.broadcast_to(np.arange(width), (n, width))
        return np.argpartition(rng.random((n, width), np.float32), wanted - 1, axis=1)[:, :wanted]

    return grow_tree(bins, label, rng.poisson(1.0, len(bins)), classes, most_bins, max_depth, draw)


def _numbers(batch: pa.RecordBatch, *names: str) -> list:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in names] + [pc.list_flatten(batch.column("x")).to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)]


def fold_points(rows: DataFrame, folds: int, max_bins: list) -> dict:
    """{(max_bins, fold): split points of every feature}, from the rows of the
    other folds. ``rows``: fold, label, x. A few numbers for each feature."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, x = _numbers(batch, "fold")
            of, own = np.unique(own, return_inverse=True)
            for f in range(x.shape[1]):
                values, place = np.unique(x[:, f], return_inverse=True)
                n = np.bincount(place * len(of) + own, minlength=len(values) * len(of))
                cell = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), f, np.int32)), pa.array(values[cell // len(of)]),
                                                  pa.array(of[cell % len(of)].astype(np.int32)), pa.array(n[cell])], names=["feature", "value", "fold", "n"])

    def chosen(values: pa.Table) -> pa.Table:
        value, place = np.unique(values.column("value").to_numpy(), return_inverse=True)
        fold, n = values.column("fold").to_numpy(), values.column("n").to_numpy()
        found = []
        for k in range(folds):
            held = np.bincount(place, np.where(fold != k, n, 0), len(value))
            some, count = value[held > 0], held[held > 0]
            found += [(b, k, split_points(some, count, min(b, int(count.sum())) - 1)) for b in max_bins]
        return pa.table({"feature": pa.array([values.column("feature")[0].as_py()] * len(found), pa.int32()), "max_bins": pa.array([b for b, _, _ in found], pa.int32()),
                         "fold": pa.array([k for _, k, _ in found], pa.int32()), "points": pa.array([p for _, _, p in found], pa.list_(pa.float64()))})

    out: dict = {}
    for r in rows.mapInArrow(counted, VALUES).groupBy("feature").applyInArrow(chosen, POINTS).collect():
        out.setdefault((r.max_bins, r.fold), {})[r.feature] = np.array(r.points)
    return {job: [points[f] for f in range(len(points))] for job, points in out.items()}


def _given(rows: DataFrame, label: str, features: str, fold) -> DataFrame:
    return rows.select(fold.cast("int").alias("fold"), F.col(label).cast("int").alias("label"), vector_to_array(features).alias("x")).filter("fold IS NOT NULL")


def _deal(rows: DataFrame, points: list, kind: type) -> DataFrame:
    """The rows in bins for each job (``points`` has the split points of each),
    a partition for a job."""
    block = pa.schema([("job", pa.int32()), ("part", pa.int32()), ("at", pa.int64()), ("bins", pa.binary()), ("label", pa.binary()), ("fold", pa.binary())])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            own, y, x = _numbers(batch, "fold", "label")
            by_feature, last, bins = np.ascontiguousarray(x.T), None, b""
            for j, of in enumerate(points):
                if of is not last:  # trees of one forest have the same
                    last, bins = of, np.stack([np.searchsorted(p, v).astype(kind) for p, v in zip(of, by_feature, strict=True)], axis=1).tobytes()
                yield pa.RecordBatch.from_pylist([{"job": j, "part": part, "at": at, "bins": bins, "label": y.astype(np.int32).tobytes(),
                                                   "fold": own.astype(np.int32).tobytes()}], schema=block)
            at += len(y)

    return rows.mapInArrow(dealt, BLOCKS).repartitionById(len(points), "job")


def _gathered(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[tuple]:
    """(job, bins, label, fold) of each job dealt here, rows in their first order."""
    blocks: dict = {}
    for batch in batches:
        for row in batch.to_pylist():
            blocks.setdefault(row["job"], []).append(row)
    for j in sorted(blocks):
        own = sorted(blocks.pop(j), key=lambda row: (row["part"], row["at"]))
        joined = lambda c, t, own=own: np.concatenate([np.frombuffer(row[c], t) for row in own])
        label = joined("label", np.int32).astype(np.int64)
        yield j, joined("bins", kind).reshape(len(label), -1), label, joined("fold", np.int32)


def _kind(max_bins: int) -> type:
    return np.uint8 if max_bins <= 256 else np.uint16


def grown_scores(rows: DataFrame, label: str, features: str, fold: str, folds: int, num_trees: list, max_depth: list, max_bins: list,
                 seed: int, columns: str) -> DataFrame:
    """One row (``columns``) a (num_trees, max_depth, max_bins, fold), as
    ``forest_search.nested_search`` gives: a task for each fold and bin count,
    which holds the rows at a byte a feature."""
    from outletlab.plans.forest_search import NodeTable

    given = _given(rows, label, features, F.col(fold))
    points = fold_points(given, folds, max_bins)
    jobs, kind = sorted(points), _kind(max(max_bins))
    names = [c.split()[0] for c in columns.split(", ")]
    result = pa.schema([(c, pa.int64() if of == "long" else pa.int32()) for c, of in (x.split() for x in columns.split(", "))])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for j, bins, y, of in _gathered(batches, kind):
            (most, k), classes = jobs[j], int(y.max()) + 1
            held = of == k
            if not held.any():
                continue
            if held.all():
                raise ValueError(f"no row to fit on beside fold {k}")
            trees = [grow_drawn(bins[~held], y[~held], classes, most, t, max(num_trees), max(max_depth), seed) for t in range(max(num_trees))]
            found = NodeTable.grown(trees).correct(bins[held], y[held], num_trees, max_depth)
            yield pa.RecordBatch.from_pylist([dict(zip(names, (t, d, most, k, right, int(held.sum())), strict=True)) for (t, d), right in found.items()], schema=result)

    return _deal(given, [points[job] for job in jobs], kind).mapInArrow(scored, columns)


# ------------------------------------------------ a forest in MLlib's own form


NODE = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
        "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")


def _stored_nodes(tree: int, grown: dict, points: list, binary: list, max_depth: int) -> pa.RecordBatch:
    """The nodes of a tree as MLlib stores them: pruned, and children after their parents."""
    from outletlab.plans.forest_search import NodeTable

    table = NodeTable.grown([grown])
    leaf, kept = table.leaves(max_depth), np.zeros(len(table.inner), bool)
    level = table.roots
    while len(level):
        kept[level] = True
        level = level[~leaf[level]]
        level = np.concatenate([table.left[level], table.right[level]])
    node, inner = np.flatnonzero(kept), ~leaf[kept]
    place = np.cumsum(kept) - 1
    counts, total = grown["counts"], grown["counts"].sum(axis=1)
    impurity, a, b = gini(counts, total), table.left[node], table.right[node]
    gain = np.where(inner, impurity[node] - total[a] / total[node] * impurity[a] - total[b] / total[node] * impurity[b], -1.0)
    feature = np.where(inner, table.feature[node], -1)
    lists = np.isin(feature, binary)  # 0 goes left: a category to MLlib
    value = np.array([0.0 if c or f < 0 else points[f][t] for f, t, c in zip(feature, grown["last"][node], lists, strict=True)])
    ends = lambda sizes: pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
    whole = lambda x: pa.array(np.asarray(x), pa.int32())
    split = pa.StructArray.from_arrays([whole(feature), pa.ListArray.from_arrays(ends(inner), pa.array(value[inner])), whole(np.where(lists, 2, -1))],
                                       ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    data = pa.StructArray.from_arrays(
        [whole(np.arange(len(node))), pa.array(table.prediction[node].astype(float)), pa.array(impurity[node]),
         pa.ListArray.from_arrays(ends(np.full(len(node), counts.shape[1])), pa.array(counts[node].reshape(-1))), pa.array(total[node].astype(np.int64)),
         pa.array(gain), whole(np.where(inner, place[a], -1)), whole(np.where(inner, place[b], -1)), split],
        ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
    return pa.RecordBatch.from_arrays([whole(np.full(len(node), tree)), data], names=["treeID", "nodeData"])


def _stored_head(model_class: str, uid: str, estimator: RandomForestClassifier, only: set, **more) -> str:
    """What MLlib stores of a model beside its nodes."""
    named = lambda values: {p.name: v for p, v in values.items() if p.name in only}
    return json.dumps({"class": f"org.apache.spark.ml.classification.{model_class}", "timestamp": int(time.time() * 1000), "sparkVersion": pyspark.__version__, "uid": uid,
                       "paramMap": named(estimator._paramMap), "defaultParamMap": named(estimator._defaultParamMap), **more})


def grown_forest(estimator: RandomForestClassifier, rows: DataFrame, path: str) -> RandomForestClassificationModel:
    """The forest of ``estimator`` (its tree count, depth, bin count and seed),
    a task for each tree, stored at ``path`` by the executors in the form that
    MLlib's models are stored in, and loaded from there. ``stored_at`` of the
    model is that path."""
    spark, label, features = rows.sparkSession, estimator.getLabelCol(), estimator.getFeaturesCol()
    num_trees, max_depth, most, seed = estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getMaxBins(), estimator.getSeed()
    given = _given(rows, label, features, F.lit(-1))
    points = fold_points(given, 1, [most])[(most, 0)]
    named = rows.schema[label].metadata.get("ml_attr", {}).get("vals")
    classes = len(named) if named else given.agg(F.max("label")).first()[0] + 1
    binary = [a["idx"] for a in rows.schema[features].metadata.get("ml_attr", {}).get("attrs", {}).get("binary", [])]
    kind = _kind(most)

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, bins, y, _ in _gathered(batches, kind):
            yield _stored_nodes(tree, grow_drawn(bins, y, classes, most, tree, num_trees, max_depth, seed), points, binary, max_depth)

    _deal(given, [points] * num_trees, kind).mapInArrow(grown, NODE).write.parquet(f"{path}/data")
    of_tree = {p.name for p in DecisionTreeClassifier().params}
    trees = [(t, _stored_head("DecisionTreeClassificationModel", f"dtc_{uuid.uuid4().hex[:12]}", estimator, of_tree), 1.0) for t in range(num_trees)]
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    head = _stored_head("RandomForestClassificationModel", estimator.uid, estimator, {p.name for p in estimator.params},
                        numFeatures=len(points), numClasses=classes, numTrees=num_trees)
    spark.createDataFrame([(head,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    model = RandomForestClassificationModel.load(path)
    model.stored_at = path
    return model
