"""Evaluation metrics from predictions."""

from outletlab.operators import metrics as me


def preds(spark):
    rows = [(1.0, 1.0, 0.9, "T"), (1.0, 2.0, 0.8, "T"), (2.0, 2.0, 0.3, "T"), (2.0, 2.0, 0.3, "T"),
            (3.0, 1.0, 0.1, "T"), (3.0, 6.0, 0.5, "T")]   # class 6 only predicted
    return spark.createDataFrame(rows, "label double, prediction double, probability double, g string")


def test_confusion_and_metrics(spark):
    df = preds(spark)
    cm = {(r.label, r.prediction): r.n for r in me.confusion_matrix(df).collect()}
    assert cm[(2.0, 2.0)] == 2 and sum(cm.values()) == 6
    m = {(r.metric, r["class"]): r.value for r in me.classification_metrics(df, by="g").collect()}
    assert m[("accuracy", None)] == 3 / 6
    assert m[("precision", 1.0)] == 1 / 2 and m[("recall", 1.0)] == 1 / 2
    assert m[("precision", 2.0)] == 2 / 3 and m[("recall", 2.0)] == 1.0
    assert m[("precision", 6.0)] == 0.0 and m[("recall", 3.0)] == 0.0
    wp = (2 / 6) * (1 / 2) + (2 / 6) * (2 / 3) + (2 / 6) * 0.0
    assert abs(m[("weighted_precision", None)] - wp) < 1e-12
    wide = me.confusion_matrix_wide(df).collect()
    assert len(wide) == 3


def brute_auc(rows, cls):
    pos = [s for lab, _, s, _ in rows if lab == cls]
    neg = [s for lab, _, s, _ in rows if lab != cls]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def test_auc_matches_pairwise_definition(spark):
    rows = [(float(i % 3), 0.0, round((i * 37 % 101) / 101, 2), "T") for i in range(200)]
    df = spark.createDataFrame(rows, "label double, prediction double, probability double, g string")
    got = {r["class"]: r.auc for r in me.auc_one_vs_rest(df, partitions=7).collect()}
    for cls in (0.0, 1.0, 2.0):
        assert abs(got[cls] - brute_auc(rows, cls)) < 1e-12
    grouped = {r["class"]: r.auc for r in me.auc_one_vs_rest(df, by="g").collect()}
    assert grouped == got


def test_metric_table(spark):
    t = me.metric_table(preds(spark), by="g").first()
    assert t.accuracy == 0.5 and t.auc is not None


def test_auc_from_class_scores(spark):
    rows = [("A", 0.9, 0.1, "T"), ("A", 0.6, 0.4, "T"), ("B", 0.3, 0.7, "T"), ("B", 0.6, 0.2, "T")]
    df = spark.createDataFrame(rows, "lab string, pa double, pb double, g string")
    got = {r["class"]: r.auc for r in me.auc_from_class_scores(df, "lab", {"A": "pa", "B": "pb"}, by="g").collect()}
    # A: positives (0.9, 0.6) vs negatives (0.3, 0.6) -> (1 + 1 + 1 + 0.5) / 4
    assert got["A"] == 3.5 / 4
    assert got["B"] == 3 / 4  # 0.7 beats both negatives, 0.2 beats 0.1 only


def test_auc_with_scores_in_a_narrow_band_and_ties(spark):
    rows = [(float(i % 2), 0.0, 0.5 + (i % 9) * 1e-7, "T") for i in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double, probability double, g string")
    got = {r["class"]: r.auc for r in me.auc_one_vs_rest(df, partitions=5).collect()}
    for cls in (0.0, 1.0):
        assert abs(got[cls] - brute_auc(rows, cls)) < 1e-12


def test_rows_without_score_or_label_are_left_out(spark):
    rows = [(1.0, 0.9), (1.0, 0.8), (1.0, None), (1.0, None), (0.0, 0.1), (0.0, 0.2), (0.0, None), (None, 0.5)]
    df = spark.createDataFrame([(a, a, b, None) for a, b in rows], "label double, prediction double, probability double, g string")
    assert {r["class"]: r.auc for r in me.auc_one_vs_rest(df).collect()} == {1.0: 1.0, 0.0: 0.0}
    grouped = me.metric_table(df, by="g").collect()  # a NULL group is a group
    assert len(grouped) == 1 and grouped[0].accuracy == 1.0 and grouped[0].auc == 0.5


def test_classes_called_by_name(spark):
    df = spark.createDataFrame([("Gold", "Gold"), ("Gold", "Iron"), ("Iron", "Iron"), (None, "Iron"), ("Iron", None)], "label string, prediction string")
    got = {(r.metric, r["class"]): r.value for r in me.classification_metrics(df).collect()}
    assert got[("accuracy", None)] == 2 / 3 and got[("precision", "Iron")] == 0.5 and got[("recall", "Gold")] == 0.5


def test_one_vs_one_equals_counting_pairs(spark):
    names = ["A", "B", "C"]
    rows = [(names[i * 7 % 3], *(None if (i + k) % 11 == 0 else (i * (13 + k) % 17) / 17 for k in range(3))) for i in range(90)]
    df = spark.createDataFrame(rows, "lab string, A double, B double, C double")
    pairs = []
    for i, j in ((0, 1), (0, 2), (1, 2)):
        both = []
        for own, other in ((i, j), (j, i)):
            scores = {c: [r[1 + own] for r in rows if r[0] == names[c] and r[1 + i] is not None and r[1 + j] is not None] for c in (own, other)}
            wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in scores[own] for n in scores[other])
            both.append(wins / (len(scores[own]) * len(scores[other])))
        pairs.append(sum(both) / 2)
    got = me.auc_one_vs_one(df, "lab", {c: c for c in names}).first().auc
    assert abs(got - sum(pairs) / 3) < 1e-12
