"""Driver contract and a quick oracle check at the smallest scale."""

import os

import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
QUICK = ["customer_master", "cooler_features", "demographic_features", "sales_features",
         "currency_impute", "impute_hierarchical", "stratified_split", "confusion_matrix",
         "classification_metrics", "auc_by_class", "ingest_stamp", "bulk_load", "nearest_outlet"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["CUSTOMER", "Sales_Volume_in_UC_rolling_xmonths_back_avg",
                          "Sales_NSR_rolling_xmonths_back_avg"]
    assert df.count() > 0


def test_registry_is_consistent():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 35
    assert callable(qs["sales_features"])


KEYS = list(E.oracle_sql()) if os.environ.get("OUTLETLAB_FULL_ORACLE") else QUICK


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, key):
    res = compare(spark, duck(SF), SF, key, E.queries()[key], E.oracle_sql()[key])
    assert res["ok"], res
