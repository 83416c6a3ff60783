"""Scalar helpers and the decisions they encode (routing flag, fiscal periods,
class groups)."""

from pyspark.sql import functions as F

from outletlab.functions import scalar as S


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} string" for k in cols))
    return df.select(expr.alias("v")).first()["v"]


def test_routed_flag_compares_the_column(spark):
    assert one(spark, S.routed_flag("o"), o="NR") == 0
    assert one(spark, S.routed_flag("o"), o="CW") == 1
    df = spark.createDataFrame([(None,)], "o string")
    assert df.select(S.routed_flag("o").alias("v")).first()["v"] == 1


def test_fiscal_period_shift_two_digit_months(spark):
    for period, shifted in [("2001010", "2000010"), ("2001012", "2000012"), ("2001009", "2000009"),
                            ("2001001", "2000001")]:
        assert one(spark, S.fiscal_period_shift("p", -12), p=period) == shifted
    assert one(spark, S.fiscal_period_shift("p", -1), p="2001001") == "2000012"


def test_days_since_month_start(spark):
    assert one(spark, S.days_since_month_start(S.yyyymmdd_to_date("d")), d="20010801") == 0
    assert one(spark, S.days_since_month_start(S.yyyymmdd_to_date("d")), d="20010822") == 21
    assert one(spark, S.yyyymmdd_to_date("d"), d="garbage") is None


def test_ccaf_group(spark):
    got = [one(spark, S.ccaf_group(F.substring("c", 2, 1)), c=f"C{i}") for i in range(8)]
    assert got == ["Other", "Platinum", "Gold", "Silver", "Bronze", "Iron", "Other", "Other"]


def test_column_names_are_cleaned():
    assert S.clean_column_name("a b-c.d") == "a_b_c_d"
