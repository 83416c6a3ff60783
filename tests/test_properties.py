"""Invariants from SURVEY §5 on generated data, including a hot key."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from outletlab.operators import features as fe
from outletlab.operators.impute import impute_hierarchical, impute_nearest

value = st.one_of(st.none(), st.floats(min_value=0, max_value=1000, allow_nan=False))
coord = st.one_of(st.none(), st.floats(min_value=45.0, max_value=45.2, allow_nan=False))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(coord, coord, value, value), min_size=1, max_size=30))
def test_nearest_imputation_never_changes_known_values(spark, rows):
    data = [(f"k{i:03d}", a, b, "1", x, y) for i, (a, b, x, y) in enumerate(rows)]
    df = spark.createDataFrame(data, "CUSTOMER string, LATITUDE double, LONGITUDE double, "
                                     "_BIC_CDMD_AREA string, x double, y double")
    out = {r.CUSTOMER: r for r in impute_nearest(df, ["x", "y"]).collect()}
    assert len(out) == len(data)
    for k, lat, lon, _, x, y in data:
        if x is not None:
            assert out[k].x == x
        if y is not None:
            assert out[k].y == y
        if lat is None or lon is None:
            assert (out[k].x, out[k].y) == (x, y)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["A", "B", None]), st.sampled_from(["x", "y", None]), value),
                min_size=1, max_size=40))
def test_hierarchical_output_null_only_when_column_all_null(spark, rows):
    data = [(f"k{i:03d}", ch, ar, v) for i, (ch, ar, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "CUSTOMER string, CUST_CTRADE_CH_DESC string, CUST_CDMD_AREA string, v double")
    out = impute_hierarchical(df, {"v": "w"}).collect()
    all_null = all(v is None for *_, v in data)
    for r in out:
        assert (r.w is None) == all_null
        if r.v is not None:
            assert r.w == r.v


def test_hot_customer_sales_are_exact(spark):
    # one customer holds a third of all lines
    rows = []
    for i in range(900):
        cust = "HOT" if i % 3 == 0 else f"C{i % 40:02d}"
        day = f"2001{1 + i % 8:02d}{10 + i % 15:02d}"
        rows.append((cust, day, f"20010{day[4:6]}", "1", Decimal(i % 7), None, Decimal(i % 5), None, "EUR"))
    schema = ("CUSTOMER string, CALDAY string, FISCPER string, MATERIAL string, "
              "Direct_Sales_Volume_in_UC decimal(38,3), Indirect_Sales_Volume_in_UC decimal(38,3), "
              "Direct_Sales_NSR decimal(38,2), Indirect_Sales_NSR decimal(38,2), CURRENCY string")
    df = spark.createDataFrame(rows, schema).repartition(8)
    got = {r.CUSTOMER: r[fe.SALES_VOLUME_MEAN] for r in fe.sales_features(fe.sales_amounts(df)).collect()}
    monthly = {}
    for cust, _, per, _, v, *_ in rows:
        s, n = monthly.get((cust, per), (Decimal(0), 0))
        monthly[(cust, per)] = (s + v, n + 1)
    for cust in {r[0] for r in rows}:
        num = sum(s * n for (c, _), (s, n) in monthly.items() if c == cust)
        den = sum(n for (c, _), (s, n) in monthly.items() if c == cust)
        assert got[cust] == float(num) / float(den)
