import datetime as dt

import pytest

from outletlab.spec import FeatureSpec, apply_specs, conjunction, sql_literal


def test_specs_apply_in_dependency_order(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    out = apply_specs(df, [FeatureSpec("s", ("a", "b"), "{field01} + {field02}"),
                           FeatureSpec("t", ("s",), "{field01} * 10")])
    assert out.first().asDict() == {"a": 1.0, "b": 2.0, "s": 3.0, "t": 30.0}


def test_unknown_input_is_rejected(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    with pytest.raises(ValueError):
        apply_specs(df, [FeatureSpec("s", ("zzz",), "{field01}")])


def test_predicates_are_anded_and_parameters_quoted(spark):
    df = spark.createDataFrame([("x'y", 5), ("z", 1)], "k string, v int")
    cond = conjunction(["k IN ({keys})", "v > {low}"], {"keys": ["x'y", "q"], "low": 2})
    assert [r.k for r in df.filter(cond).collect()] == ["x'y"]
    assert sql_literal(dt.date(2001, 6, 1)) == "DATE '2001-06-01'"


def test_oracle_rounding_follows_spark(spark):
    import duckdb

    from outletlab.checks.oracle import spark_rounding

    value = 0.575  # binary value is just below 0.575
    sql = spark_rounding(f"SELECT round({value}::DOUBLE, 2) AS r")
    assert duckdb.sql(sql).fetchall()[0][0] == 0.58
    assert spark.sql(f"SELECT round(CAST({value} AS DOUBLE), 2) AS r").first().r == 0.58
