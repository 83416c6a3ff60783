"""Source feature builders on hand-written frames."""

import datetime as dt
from decimal import Decimal

from outletlab.operators import features as fe


def lines(spark, rows):
    # CUSTOMER, CALDAY, FISCPER, MATERIAL, dvol, ivol, dnsr, insr, CURRENCY
    schema = ("CUSTOMER string, CALDAY string, FISCPER string, MATERIAL string, "
              "Direct_Sales_Volume_in_UC decimal(38,3), Indirect_Sales_Volume_in_UC decimal(38,3), "
              "Direct_Sales_NSR decimal(38,2), Indirect_Sales_NSR decimal(38,2), CURRENCY string")
    return spark.createDataFrame(rows, schema)


def row(c, day, per, v=None, iv=None, n=None, inn=None, cur="EUR"):
    d = lambda x: None if x is None else Decimal(str(x))
    return (c, day, per, "1", d(v), d(iv), d(n), d(inn), cur)


def test_latest_period_needs_more_than_20_days_or_month_start(spark):
    df = lines(spark, [
        row("1", "20010915", "2001009"),   # 14 days in: not complete
        row("1", "20010831", "2001008"),   # 30 days in: complete
        row("1", "20011001", "2001010"),   # first day only: qualifies by the "= 0" arm
    ])
    assert fe.latest_fiscal_period(df).first()["FISCPER"] == "2001010"
    df2 = lines(spark, [row("1", "20010915", "2001009"), row("1", "20010831", "2001008")])
    assert fe.latest_fiscal_period(df2).first()["FISCPER"] == "2001008"


def test_window_is_13_periods_across_year_end(spark):
    rows = [row("1", f"{y}{m:02d}25", f"{y}0{m:02d}", 1) for y in (2000, 2001) for m in range(1, 13)]
    df = lines(spark, rows)
    kept = sorted(r.FISCPER for r in fe.sales_in_window(df).collect())
    assert kept[0] == "2000012" and kept[-1] == "2001012" and len(kept) == 13


def test_line_weighted_and_monthly_means(spark):
    df = lines(spark, [
        row("1", "20010801", "2001008", 1), row("1", "20010802", "2001008", 1),
        row("1", "20010802", "2001008", None, 1),
        row("1", "20010701", "2001007", 6),
    ])
    amounts = fe.sales_amounts(df)
    line = fe.sales_features(amounts, "line").first()
    month = fe.sales_features(amounts, "month").first()
    # monthly sums 3 (3 lines) and 6 (1 line): line-weighted (3*3 + 6*1)/4, monthly (3+6)/2
    assert line[fe.SALES_VOLUME_MEAN] == 15 / 4
    assert month[fe.SALES_VOLUME_MEAN] == 4.5


def test_unique_currency(spark):
    df = lines(spark, [
        row("1", "20010801", "2001008", cur=None), row("1", "20010801", "2001008", cur="USD"),
        row("2", "20010801", "2001008", cur=None), row("2", "20010801", "2001008", cur="USD"),
        row("2", "20010801", "2001008", cur="EUR"),
        row("3", "20010801", "2001008", cur=None),
    ])
    got = sorted((r.CUSTOMER, r.CURRENCY) for r in fe.impute_unique_currency(df).collect())
    assert got == [("1", "USD"), ("1", "USD"), ("2", "EUR"), ("2", "NA"), ("2", "USD"), ("3", "NA")]


def test_cooler_features_distinct_rows_latest_period(spark):
    schema = ("CUSTOMER string, EQUIPMENT string, FISCPER string, CUSTOMERS_WITH_COOLERS string, "
              "DF_STATUS_D string, ACTUAL_DOORS string")
    raw = spark.createDataFrame([
        ("1", "e1", "2001008", "1", "placed", "2"),
        ("1", "e1", "2001008", "1", "placed", "2"),   # duplicate row counts once
        ("1", "e1", "2001008", "1", "placed", "3"),   # same equipment, other doors
        ("1", "e2", "2001008", "1", "placed", "1"),
        ("1", "e3", "2001008", "0", "placed", "5"),   # no coolers flag
        ("1", "e4", "2001008", "1", "returned", "5"),
        ("1", "e5", "2001008", "1", "placed", "0"),   # no doors
        ("1", "e6", "2001007", "1", "placed", "9"),   # older period
    ], schema)
    r = fe.cooler_features(raw).first()
    assert r.COOLER_DOORS_SUM == Decimal("6.0") and r.COOLER_EQUIP_COUNT == 2


def test_customer_filter(spark):
    cols = ["CUSTOMER", "SALESORG", "ACCNT_GRP", "CUST_HIE02", "_BIC_CSUP_CUST", "_BIC_CTRADE_CH",
            "CTRADE_CH_DESC", "_BIC_CSUB_TRAD", "CSUB_TRAD_DESC", "_BIC_CDMD_AREA", "CDMD_AREA_DESC",
            "CUST_GRP4", "CUST_GRP4_DESC", "POSTAL_CD", "ERDAT", "_BIC_C_CCAF", "LATITUDE", "LONGITUDE"]
    base = dict(zip(cols, ["0000000001", "7800", "Z001", "KA", None, "010", None, "001", "d", "1", "A",
                           "G", "g", "1000", "20010101", "C2", "45.5", "bad"]))
    variants = [
        {},                                   # kept, NULL order block
        {"CUSTOMER": "0000000002", "_BIC_CSUP_CUST": "NR"},   # kept, not routed
        {"CUSTOMER": "0000000003", "_BIC_CSUP_CUST": "ZZ"},   # blocked
        {"CUSTOMER": "0000000004", "_BIC_CTRADE_CH": "036"},  # excluded channel
        {"CUSTOMER": "0000000005", "_BIC_CTRADE_CH": None},   # NULL channel: NOT IN drops it
        {"CUSTOMER": "0000000006", "ERDAT": "20010702"},      # created too recently
        {"CUSTOMER": "0000000007", "CUST_HIE02": "XX"},
        {"CUSTOMER": "0000000008", "SALESORG": "1100"},
    ]
    rows = [tuple({**base, **v}[c] for c in cols) for v in variants]
    raw = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))
    out = {r.CUSTOMER: r for r in
           fe.customer_features(raw, ["7800"], ["Z001"], dt.date(2001, 10, 1)).collect()}
    assert sorted(out) == ["0000000001", "0000000002"]
    assert out["0000000001"].CUST_ROUTED == 1 and out["0000000002"].CUST_ROUTED == 0
    assert out["0000000001"].CUST_CCAF_GROUP == "Gold"
    assert out["0000000001"].CUST_CTRADE_CH_DESC == "UNKNOWN"   # filled before the star join
    assert out["0000000001"].LATITUDE == 45.5 and out["0000000001"].LONGITUDE is None
