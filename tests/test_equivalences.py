"""The rewritten forms equal the forms they replace."""

from decimal import Decimal

from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import Window
from pyspark.sql import functions as F

from outletlab.operators import features as fe
from outletlab.operators import metrics as me
from outletlab.operators import select as sel


def test_line_weighted_mean_equals_window_form(spark):
    rows = [(f"c{i % 7}", f"20010{1 + i % 9}", Decimal(i % 13) + Decimal("0.125")) for i in range(300)]
    df = spark.createDataFrame(rows, "CUSTOMER string, FISCPER string, v decimal(38,3)")
    amounts = df.select("CUSTOMER", "FISCPER", F.col("v").alias("Sales_Volume_in_UC"),
                        F.col("v").alias("Sales_NSR"), F.lit("20010101").alias("CALDAY"))
    ours = {r.CUSTOMER: r[fe.SALES_VOLUME_MEAN] for r in fe.sales_features(amounts).collect()}
    w_month = Window.partitionBy("CUSTOMER", "FISCPER")
    w_cust = Window.partitionBy("CUSTOMER")
    ref = (df.withColumn("m", F.sum("v").over(w_month))
           .withColumn("a", F.avg(F.col("m").cast("double")).over(w_cust))
           .select("CUSTOMER", "a").distinct())
    for r in ref.collect():
        assert abs(ours[r.CUSTOMER] - r.a) < 1e-9


def test_chi_square_equals_mllib_when_dof_above_one(spark):
    rows = [(float(i % 3), float((i * 7) % 4), float(i % 5)) for i in range(120)]
    df = spark.createDataFrame(rows, "y double, a double, b double")
    ours = {r.feature: r for r in sel.chi_square(df, ["a", "b"], "y").collect()}
    vec = spark.createDataFrame([(r[0], Vectors.dense([r[1], r[2]])) for r in rows], ["y", "features"])
    ml = ChiSquareTest.test(vec, "features", "y").first()
    for i, f in enumerate(["a", "b"]):
        assert ours[f].dof == ml.degreesOfFreedom[i]
        assert abs(ours[f].chi2 - ml.statistics[i]) < 1e-9
        assert abs(ours[f].p_value - ml.pValues[i]) < 1e-9


def test_metrics_equal_mllib_multiclass(spark):
    from pyspark.mllib.evaluation import MulticlassMetrics

    rows = [(float(i % 4), float((i * 3 + i // 5) % 4)) for i in range(200)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    m = {(r.metric, r["class"]): r.value for r in me.classification_metrics(df).collect()}
    mm = MulticlassMetrics(df.select("prediction", "label").rdd.map(tuple))
    assert abs(m[("accuracy", None)] - mm.accuracy) < 1e-12
    assert abs(m[("weighted_precision", None)] - mm.weightedPrecision) < 1e-12
    assert abs(m[("weighted_recall", None)] - mm.weightedRecall) < 1e-12
    assert abs(m[("weighted_f1", None)] - mm.weightedFMeasure()) < 1e-12
    for c in (0.0, 1.0, 2.0, 3.0):
        assert abs(m[("precision", c)] - mm.precision(c)) < 1e-12
        assert abs(m[("recall", c)] - mm.recall(c)) < 1e-12
        assert abs(m[("f1", c)] - mm.fMeasure(c)) < 1e-12
