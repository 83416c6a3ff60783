"""One-call plans of the original entry points."""

import tempfile

import pytest

import __spark_entry__ as E

from outletlab.checks import params as P
from outletlab.checks import queries as Q
from outletlab.plans.base_table import build_and_store_base_table
from outletlab.plans import model as mo
from outletlab.sources import files as fs
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
MODEL_SF = "/root/testdata/sf0.01"


def test_base_table_run_twice_appends_nothing_new(spark):
    root = tempfile.mkdtemp(prefix="abt-runs-")
    args = (Q._customers(spark, SF), Q._demographics(spark, SF), Q.cooler_features(spark, SF),
            Q.sales_features(spark, SF))
    first = build_and_store_base_table(spark, *args, root, P.COUNTRY, "20011101", "20011101_000001")
    second = build_and_store_base_table(spark, *args, root, P.COUNTRY, "20011102", "20011102_000001")
    a = spark.read.option("header", True).csv(first)
    b = spark.read.option("header", True).csv(second)
    assert a.count() == b.count() > 0
    assert {r.pardt for r in b.select("pardt").distinct().collect()} == {"20011101"}
    assert fs.latest_dataset_directory(spark, root).endswith("20011102_000001.csv")


@pytest.fixture(scope="module")
def small_search():
    """One parameter set on two folds; the registered queries run the whole grid."""
    whole, Q.MODEL_CONFIG = Q.MODEL_CONFIG, mo.ModelConfig([5], [4], [8], folds=2)
    yield
    Q.MODEL_CONFIG = whole


def test_the_whole_grid_is_the_default():
    cfg = Q.MODEL_CONFIG
    assert len(cfg.num_trees) * len(cfg.max_depth) * len(cfg.max_bins) == 100 and cfg.folds == 5


@pytest.mark.parametrize("key", ["mbt_base", "mbt_scores", "model_roundtrip", "model_shape"])
def test_model_queries_match_their_oracles(spark, small_search, key):
    res = compare(spark, duck(MODEL_SF), MODEL_SF, key, E.queries()[key], E.oracle_sql()[key])
    assert res["ok"], res


def test_search_scores_match_their_oracle(spark, small_search):
    from outletlab.checks.oracle import model_search

    sql = E.spark_rounding(model_search([5], [4], [8], 2))
    res = compare(spark, duck(MODEL_SF), MODEL_SF, "model_search", Q.model_search, sql)
    assert res["ok"], res


def test_model_metrics_recomputed_from_the_predictions(spark, small_search):
    rows = {r.Holdout: r for r in Q.mbt_metrics(spark, MODEL_SF).collect()}
    table = Q.mbt(spark, MODEL_SF).filter("Holdout IS NOT NULL").toPandas()
    assert set(rows) == set(table.Holdout)
    for part, frame in table.groupby("Holdout"):
        assert abs(rows[part].accuracy - (frame.PREDICTED_targetVar == frame.labelCol).mean()) < 1e-12
        assert 0 <= rows[part].auc <= 1 and 0 <= rows[part].auc_ovo <= 1
    importances = Q.feature_importances(spark, MODEL_SF).collect()
    assert abs(sum(r.score for r in importances) - 1) < 1e-9


def test_nothing_significant_is_an_error(spark):
    df = spark.createDataFrame([(str(i % 2), str(i // 2 % 2)) for i in range(80)], "x string, y string")
    with pytest.raises(ValueError, match="none of 1 features"):
        mo.select_features(df, ["x"], "y")
