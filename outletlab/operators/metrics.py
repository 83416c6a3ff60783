"""Classifier evaluation from DataFrames: confusion matrix, accuracy,
per-class and weighted precision / recall / F1, one-vs-rest AUC, feature
importances.

The confusion matrix is one map-side-combined group-by; every metric is
derived from it (classes^2 rows per group), so the prediction table is read
once whatever its size. AUC uses rank sums with average ranks for ties;
ranks come from range-partitioned prefix counts so no window spans a whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from outletlab.plans.joins import null_safe_keys
from outletlab.session import cut_lineage


def _group_cols(by):
    return [by] if isinstance(by, str) else list(by or [])


def _join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; the left keys are kept."""
    right, cond = null_safe_keys(left, right, keys)
    return left.join(right, cond, how).drop(*[f"{k}__r" for k in keys])


def _attach(df: DataFrame, totals: DataFrame, g, name: str) -> DataFrame:
    """Join per-group totals; without groups the one-row total is a scalar
    subquery (no cartesian product)."""
    return _join(df, totals, g) if g else df.withColumn(name, totals.select(name).scalar())


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     by=None) -> DataFrame:
    """(by..., label, prediction, n)."""
    g = _group_cols(by)
    return df.groupBy(*g, label, prediction).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix_wide(df: DataFrame, label: str = "label", prediction: str = "prediction",
                          by=None, classes=None) -> DataFrame:
    """Rows = actual class, one column per predicted class."""
    g = _group_cols(by)
    cm = confusion_matrix(df, label, prediction, by)
    piv = cm.groupBy(*g, label).pivot(prediction, classes).agg(F.first("n"))
    return piv.select(*g, label, *[F.coalesce(piv[f"`{c}`"], F.lit(0)).alias(c) for c in piv.columns if c not in (*g, label)])


def class_statistics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     by=None) -> DataFrame:
    """(by..., class, tp, actual, predicted, total, precision, recall, f1) for
    every class seen as a label or as a prediction. Rows whose label or
    prediction is NULL are not scored and count nowhere; NULL groups are kept."""
    g = _group_cols(by)
    cm = confusion_matrix(df, label, prediction, by).filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    n = F.col("n")
    sides = cm.select(*g, F.inline(F.array(
        F.struct(F.col(label).alias("class"), n.alias("actual"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col(label) == F.col(prediction), n).otherwise(0).alias("tp")),
        F.struct(F.col(prediction).alias("class"), F.lit(0).cast("long").alias("actual"), n.alias("predicted"),
                 F.lit(0).cast("long").alias("tp")))))
    st = sides.groupBy(*g, "class").agg(*[F.sum(c).alias(c) for c in ("tp", "actual", "predicted")])
    totals = cm.groupBy(*g).agg(F.sum("n").alias("total"))
    st = _attach(st, totals, g, "total")
    precision = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("actual") > 0, F.col("tp") / F.col("actual")).otherwise(0.0)
    st = st.withColumns({"precision": precision, "recall": recall})
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(0.0)
    return st.withColumn("f1", f1)


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                           by=None) -> DataFrame:
    """Long form (by..., metric, class, value): precision / recall / f1 per
    class, and accuracy plus weighted precision / recall / f1 (weights =
    share of each actual class) with class NULL. Classes keep their type, so
    labels may be names."""
    g = _group_cols(by)
    st = class_statistics(df, label, prediction, by)
    per_class = st.select(*g, F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col("class").alias("class"),
                 F.col(m).cast("double").alias("value"))
        for m in ("precision", "recall", "f1")])))
    w = F.col("actual") / F.col("total")
    overall = st.groupBy(*g).agg(
        (F.sum("tp") / F.first("total")).alias("accuracy"),
        F.sum(w * F.col("precision")).alias("weighted_precision"),
        F.sum(w * F.col("recall")).alias("weighted_recall"),
        F.sum(w * F.col("f1")).alias("weighted_f1"))
    overall = overall.select(*g, F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.lit(None).cast(st.schema["class"].dataType).alias("class"),
                 F.col(m).cast("double").alias("value"))
        for m in ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1")])))
    return per_class.unionByName(overall)


def _average_ranks(scores: DataFrame, g, score: str, partitions: int | None = None) -> DataFrame:
    """For a table with one row per (group, score) and a count ``cnt``, add
    ``avg_rank`` = #rows with a smaller score + (cnt + 1) / 2.

    Distributed ranking without a window over a whole group: the table is
    range-partitioned on (group, score), so partitions are balanced by
    sampled boundaries and equal keys share a partition. The partition tag
    is written once; per-(group, partition) totals (a small table) give each
    partition's offset, and the running count is a window inside one
    partition.
    """
    spark = scores.sparkSession
    n = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = scores.repartitionByRange(n, *g, score).withColumn("_p", F.spark_partition_id())
    ordered = cut_lineage(ordered, "ranked_scores")  # one fixed assignment for both branches
    per_part = ordered.groupBy(*g, "_p").agg(F.sum("cnt").alias("_pcnt"))
    wp = Window.partitionBy(*g).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    per_part = per_part.withColumn("_pbefore", F.coalesce(F.sum("_pcnt").over(wp), F.lit(0)))
    ordered = _join(ordered, per_part.drop("_pcnt"), g + ["_p"])
    wi = Window.partitionBy(*g, "_p").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    ordered = ordered.withColumn("_inbefore", F.coalesce(F.sum("cnt").over(wi), F.lit(0)))
    return ordered.withColumn(
        "avg_rank", F.col("_pbefore") + F.col("_inbefore") + (F.col("cnt") + 1) / 2.0
    ).drop("_p", "_pbefore", "_inbefore")


def auc_one_vs_rest(df: DataFrame, label: str = "label", score: str = "probability", by=None,
                    partitions: int | None = None, materialize: bool = True) -> DataFrame:
    """(by..., class, auc): area under the ROC curve of ``score`` for each
    label class against the rest (Mann-Whitney rank sum, ties share the
    average rank). Rows without a score or a label are left out. With
    ``materialize`` the (score, class) counts are written once; ranks,
    positives and totals all read that copy."""
    g = _group_cols(by)
    df = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    per = df.groupBy(*g, score, label).agg(F.count(F.lit(1)).alias("n"))
    if materialize:
        per = cut_lineage(per, "score_counts")
    scores = per.groupBy(*g, score).agg(F.sum("n").alias("cnt"))
    ranked = _average_ranks(scores, g, score, partitions)
    cells = _join(per, ranked.select(*g, score, "avg_rank"), g + [score])
    pos = cells.groupBy(*g, F.col(label).alias("class")).agg(
        F.sum(F.col("n") * F.col("avg_rank")).alias("rank_sum"), F.sum("n").alias("n_pos"))
    totals = per.groupBy(*g).agg(F.sum("n").alias("n_all"))
    pos = _attach(pos, totals, g, "n_all")
    n_neg = F.col("n_all") - F.col("n_pos")
    auc = F.when((F.col("n_pos") > 0) & (n_neg > 0),
                 (F.col("rank_sum") - F.col("n_pos") * (F.col("n_pos") + 1) / 2.0)
                 / (F.col("n_pos") * n_neg))
    return pos.select(*g, "class", auc.alias("auc"))


def metric_table(df: DataFrame, label: str = "label", prediction: str = "prediction",
                 score: str | None = "probability", by="Holdout") -> DataFrame:
    """One row per ``by`` value: accuracy, weighted precision / recall / f1,
    and (with a score) the prevalence-weighted one-vs-rest AUC."""
    g = _group_cols(by)
    m = classification_metrics(df, label, prediction, by).filter(F.col("class").isNull())
    wide = m.groupBy(*g).pivot("metric", ["accuracy", "weighted_precision", "weighted_recall",
                                          "weighted_f1"]).agg(F.first("value"))
    if score is None:
        return wide
    auc = auc_one_vs_rest(df, label, score, by)
    prev = (df.filter(F.col(score).isNotNull()).groupBy(*g, F.col(label).alias("class"))
            .agg(F.count(F.lit(1)).alias("k")))
    auc = _join(auc, prev, g + ["class"]).groupBy(*g).agg(
        (F.sum(F.col("auc") * F.col("k")) / F.sum("k")).alias("auc"))
    return _join(wide, auc, g, "left") if g else wide.withColumn("auc", auc.select("auc").scalar())


def feature_importances(importances, features_schema_field) -> list:
    """(name, idx, score) for every assembled feature with score > 0, best
    first. ``features_schema_field`` is the StructField of the assembled
    vector column; names come from its ML attribute metadata (driver-side
    metadata only)."""
    attrs = features_schema_field.metadata.get("ml_attr", {}).get("attrs", {})
    rows = []
    for group in attrs.values():
        for a in group:
            rows.append((a.get("name"), int(a["idx"]), float(importances[int(a["idx"])])))
    return sorted([r for r in rows if r[2] > 0], key=lambda r: (-r[2], r[1]))


def auc_from_class_scores(df: DataFrame, label: str, score_columns: dict, by=None,
                          partitions: int | None = None) -> DataFrame:
    """One-vs-rest AUC where each class has its own score column
    (``score_columns`` maps class value -> column, e.g. a model's per-class
    probability). All classes are ranked in one job: the table is stacked to
    (class, score, positive) rows and ranked per (group, class)."""
    g = _group_cols(by)
    stacked = df.select(*g, F.col(label).alias("_label"), F.explode(F.array(*[
        F.struct(F.lit(cls).alias("_cls"), F.col(col).cast("double").alias("_score"))
        for cls, col in score_columns.items()])).alias("_s"))
    stacked = stacked.select(*g, "_s._cls", "_s._score",
                             (F.col("_label") == F.col("_s._cls")).alias("_pos"))
    stacked = stacked.filter(F.col("_score").isNotNull() & F.col("_pos").isNotNull())
    out = auc_one_vs_rest(stacked, label="_pos", score="_score", by=g + ["_cls"], partitions=partitions)
    return out.filter("class").select(*g, F.col("_cls").alias("class"), "auc")


def _counts_before(scores: DataFrame, g, score: str, counts: list, partitions: int | None = None) -> DataFrame:
    """For a table with one row a (group, score) add ``before_<c>`` for each of
    ``counts``: its sum over the group's rows with a smaller score. As in
    ``_average_ranks`` the table is dealt by ranges of (group, score), so that no
    window spans more than a partition."""
    spark = scores.sparkSession
    n = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = scores.repartitionByRange(n, *g, score).withColumn("_p", F.spark_partition_id())
    ordered = cut_lineage(ordered, "ranked_scores")  # one fixed assignment for both branches
    earlier = Window.partitionBy(*g).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy(*g, "_p").agg(*[F.sum(c).alias(f"_{c}") for c in counts])
    parts = parts.select(*g, "_p", *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}") for c in counts])
    inside = Window.partitionBy(*g, "_p").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    ordered = _join(ordered, parts, [*g, "_p"])
    return ordered.withColumns({f"before_{c}": F.col(f"_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in counts}).drop(
        "_p", *[f"_{c}" for c in counts])


def auc_one_vs_one(df: DataFrame, label: str, score_columns: dict, by=None,
                   partitions: int | None = None) -> DataFrame:
    """(by..., auc): the mean over all pairs of classes of the AUC that tells
    the two apart, itself the mean of ranking their rows by the one class's
    score and by the other's. Every row is ranked once by each class's score;
    a score carries how many rows of its class and of each other class have it,
    and the running counts of the others give the AUC of every pair with that
    class (ties count half). Rows without a label or without both scores of a
    pair are left out of it, and pairs with one class missing are left out of
    the mean.
    """
    g = _group_cols(by)
    classes = list(score_columns)
    known = [F.col(score_columns[c]).isNotNull().alias(f"_has{i}") for i, c in enumerate(classes)]
    stacked = df.filter(F.col(label).isin(*classes)).select(*g, F.col(label).alias("_label"), *known, F.posexplode(F.array(*[
        F.col(score_columns[c]).cast("double") for c in classes])).alias("_own", "_score")).filter("_score IS NOT NULL")
    names = F.array(*[F.lit(c) for c in classes])
    mine = F.col("_label") == F.element_at(names, F.col("_own") + 1)
    count = lambda test: F.sum(F.when(test, 1).otherwise(0))
    counts = [f"{kind}{i}" for kind in ("pos", "neg") for i in range(len(classes))]
    scores = stacked.groupBy(*g, "_own", "_score").agg(
        *[count(mine & F.col(f"_has{i}")).alias(f"pos{i}") for i in range(len(classes))],
        *[count((F.col("_label") == F.lit(c)) & F.col(f"_has{i}")).alias(f"neg{i}") for i, c in enumerate(classes)])
    before = _counts_before(scores, [*g, "_own"], "_score", counts[len(classes):], partitions)
    won = lambda i: F.col(f"pos{i}") * (F.col(f"before_neg{i}") + F.col(f"neg{i}") / 2.0)
    sums = before.groupBy(*g, "_own").agg(*[F.sum(won(i)).alias(f"won{i}") for i in range(len(classes))],
                                          *[F.sum(c).alias(c) for c in counts])
    rows = sums.select(*g, "_own", F.inline(F.array(*[
        F.struct(F.lit(i).alias("_other"), F.col(f"won{i}").alias("won"), (F.col(f"pos{i}") * F.col(f"neg{i}")).alias("of"))
        for i in range(len(classes))]))).filter("_own <> _other AND of > 0")
    pairs = rows.groupBy(*g, F.least("_own", "_other").alias("_a"), F.greatest("_own", "_other").alias("_b")).agg(F.avg(F.col("won") / F.col("of")).alias("auc"))
    return pairs.groupBy(*g).agg(F.avg("auc").alias("auc"))
