"""Test views over the driver's TPC-H-like tables.

The reference's inputs (sales lines, calendar, customer master, coolers,
demographics, previous base table, predictions, commit log) are mapped onto
``/root/testdata/sf*/`` by SQL expressions. The same expression text is used by
the Spark views below and by the DuckDB oracle, so both see identical inputs;
the operators under test are written independently on each side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _k(x: str) -> str:
    return f"lpad(cast({x} as string), 10, '0')"


def _period(d: str) -> str:
    return f"concat(cast(year({d}) as string), lpad(cast(month({d}) as string), 3, '0'))"


def _day(d: str) -> str:
    return f"cast(year({d}) * 10000 + month({d}) * 100 + day({d}) as string)"


def _org(k: str) -> str:
    return f"case {k} % 3 when 0 then '7800' when 1 then '7900' else '1100' end"


CUSTOMER_RAW = {
    "CUSTOMER": _k("c_custkey"),
    "SALESORG": _org("c_custkey"),
    "ACCNT_GRP": "case when c_custkey % 11 = 0 then 'Z999' else 'Z001' end",
    "CUST_HIE02": "case when c_custkey % 5 < 2 then 'KA' when c_custkey % 5 < 4 then 'NK' else 'XX' end",
    "_BIC_CSUP_CUST": ("case c_custkey % 12 when 0 then null when 1 then 'NR' when 2 then 'CW' "
                       "when 3 then 'ZZ' else 'F' end"),
    "_BIC_CTRADE_CH": ("case c_mktsegment when 'AUTOMOBILE' then '010' when 'BUILDING' then '020' "
                       "when 'FURNITURE' then '036' when 'MACHINERY' then '040' else '050' end"),
    "CTRADE_CH_DESC": "c_mktsegment",
    "_BIC_CSUB_TRAD": "lpad(cast(c_custkey % 6 as string), 3, '0')",
    "CSUB_TRAD_DESC": "concat('subchannel ', cast(c_custkey % 6 as string))",
    "_BIC_CDMD_AREA": "cast(c_nationkey as string)",
    "CDMD_AREA_DESC": "n_name",
    "CUST_GRP4": "concat('G', cast(c_custkey % 4 as string))",
    "CUST_GRP4_DESC": "concat('group ', cast(c_custkey % 4 as string))",
    "POSTAL_CD": "cast(1000 + c_custkey % 900 as string)",
    "ERDAT": "case when c_custkey % 13 = 0 then '20010801' else '19990101' end",
    # a class that depends on a feature (urbanicity is 1 + c_custkey % 3), so that there is something to model
    "_BIC_C_CCAF": ("concat('C', cast(case c_custkey % 3 when 0 then c_custkey % 7 when 1 then 3 + c_custkey % 2 "
                    "else 4 + c_custkey % 2 end as string))"),
    "LATITUDE": ("case when c_custkey % 97 = 0 then null else "
                 "cast(45 + cast(c_custkey * 7919 % 10007 as double) / 10007 * 2 as string) end"),
    "LONGITUDE": ("case when c_custkey % 97 = 0 then null else "
                  "cast(13 + cast(c_custkey * 104729 % 10009 as double) / 10009 * 2 as string) end"),
}

SALES_RAW = {
    "CUSTOMER": _k("o_custkey"),
    "SALESORG": _org("o_custkey"),
    "CALDAY": _day("o_orderdate"),
    "FISCPER": _period("o_orderdate"),
    "MATERIAL": "lpad(cast(l_partkey as string), 18, '0')",
    "FIELDNM013": "case when l_linestatus = 'O' then l_quantity end",
    "FIELDNM016": "case when l_linestatus = 'F' then l_extendedprice end",
    "FIELDNM017": "case when l_linestatus = 'F' then l_quantity end",
    "FIELDNM018": "case when l_linestatus = 'O' then l_extendedprice end",
    "FIELDNM005": ("case when l_linenumber = 1 then null when o_custkey % 4 = 0 and l_linenumber = 2 "
                   "then 'USD' else 'EUR' end"),
}

CALENDAR = {"CALDAY": _day("o_orderdate"), "FISCPER": _period("o_orderdate")}

COOLERS_RAW = {
    "CUSTOMER": _k("o_custkey"),
    "COMP_CODE": "case when o_custkey % 2 = 0 then '0480' else '0491' end",
    "EQUIPMENT": "cast(l_partkey as string)",
    "FISCPER": "concat('200100', cast(6 + l_partkey % 3 as string))",
    "CUSTOMERS_WITH_COOLERS": "case when l_discount > 0 then '1' else '0' end",
    "DF_STATUS_D": "case when l_returnflag = 'A' then 'placed' else 'returned' end",
    "ACTUAL_DOORS": "cast(l_linenumber - 1 as string)",
}

# Demographic measures generated by one rule: the i-th measure is
# (100 + i) + c_custkey * (31 + 2 i) % (600 + i).
RULE_MEASURES = (
    ["age_t0014_sum", "age_t1529_sum", "age_t3044_sum", "age_t4559_sum", "age_t60pl_sum",
     "monthly_traffic_morning_avg_mean", "monthly_traffic_afternoon_avg_mean",
     "monthly_traffic_evening_avg_mean", "monthly_traffic_night_avg_mean",
     "monthly_traffic_2021_12_mean", "monthly_traffic_2021_1_mean", "monthly_traffic_2021_2_mean",
     "monthly_traffic_2021_6_mean", "monthly_traffic_2021_7_mean", "monthly_traffic_2021_8_mean",
     "monthly_traffic_weekend_avg_mean", "wvce_01_sum", "wvce_02_sum", "di_pc_mean", "hh_sum",
     "di_ci_mean", "di_mio_sum", "unempl_sum", "outlet_count"]
    + ["WVSEG_A_mean", "WVSEG_B_mean", "WVSEG_C_mean", "WVSEG_D_mean", "WVSEG_E_mean", "WVSEG_F_mean", "WVSEG_G_mean",
       "WVSEG_H_mean", "WVSEG_I_mean", "WVSEG_J_mean", "WVSEG_U_mean",
       "monthly_proportion_residents_avg_mean", "monthly_proportion_workers_avg_mean", "monthly_proportion_others_avg_mean",
       "monthly_proportion_same_state_avg_mean", "monthly_proportion_other_state_avg_mean", "monthly_proportion_unknown_avg_mean",
       "commercial_area_poi", "industrial_area_poi", "park_area_poi", "residential_area_poi", "retail_area_poi", "pofw_poi",
       "pofw_christian_poi", "pofw_muslim_poi", "parking_poi", "transport_poi", "accomodation_poi", "catering_poi",
       "education_school_poi", "education_university_poi", "health_poi", "leasure_poi", "outdoor_poi", "public_poi",
       "shopping_poi", "sports_poi", "tourism_poi"]
)

DEMOGRAPHICS_RAW = {
    "CUSTOMER": _k("c_custkey"),
    "TAA_TC": "case c_custkey % 4 when 0 then 'urban' when 1 then 'suburban' else 'rural' end",
    "urbanicity": "cast(1 + c_custkey % 3 as string)",
    "CUSTOMER_DESC": "c_name",
    "_BIC_CTRADE_CH": "'000'",
    "_BIC_CDMD_AREA": "case when c_custkey % 19 = 0 then null else cast(c_nationkey as string) end",
    "geometry": "concat('POINT ', cast(c_custkey as string))",
    "LATITUDE": "cast(45 + cast(c_custkey * 7919 % 10007 as double) / 10007 * 2 as string)",
    "LONGITUDE": "cast(13 + cast(c_custkey * 104729 % 10009 as double) / 10009 * 2 as string)",
    "pop_sum": "case when c_custkey % 10 = 0 then null else 1000 + c_custkey * 31 % 9000 end",
    "ta_size": "case when c_custkey % 17 = 0 then 0 else 1 + c_custkey % 5 end",
    "competitor_count": "c_custkey % 8",
    "monthly_traffic_avg_mean": "500 + c_custkey * 41 % 4000",
    "monthly_traffic_weekday_avg_mean": "c_custkey % 50",
    **{name: f"({100 + i}) + c_custkey * {31 + 2 * i} % {600 + i}" for i, name in enumerate(RULE_MEASURES)},
}

LABEL_CLASS = "c_custkey % 7"
PREDICTIONS = {
    "CUSTOMER": _k("c_custkey"),
    "labelName": (f"case {LABEL_CLASS} when 1 then 'Platinum' when 2 then 'Gold' when 3 then 'Silver' "
                  "when 4 then 'Bronze' when 5 then 'Iron' else 'Other' end"),
    "label": f"case when c_custkey % 59 = 0 then null else cast({LABEL_CLASS} as double) end",
    "prediction": f"cast(case when c_custkey % 4 <> 0 then {LABEL_CLASS} else (c_custkey + 1) % 7 end as double)",
    "predictionName": (f"case case when c_custkey % 4 <> 0 then {LABEL_CLASS} else (c_custkey + 1) % 7 end "
                       "when 1 then 'Platinum' when 2 then 'Gold' when 3 then 'Silver' "
                       "when 4 then 'Bronze' when 5 then 'Iron' else 'Other' end"),
    "probability": "case when c_custkey % 53 = 0 then null else cast(c_custkey * 37 % 100 as double) / 100 end",
    **{name: (f"case when c_custkey % {47 + i} = 0 then null else "
              f"cast(c_custkey * {31 + 6 * i} % 89 as double) / 89 + case when {LABEL_CLASS} = {5 - i} then 0.25 else 0 end end")
       for i, name in enumerate(["Iron", "Bronze", "Silver", "Gold"])},
    "Holdout": "case when c_custkey % 61 = 0 then null when c_custkey % 5 = 0 then 'Test' else 'Train' end",
}

COMMIT_LOG = {"operation": "event_type", "timestamp": "ts"}
WRITE_OPERATION = "purchase"

# name -> (FROM clause, column expressions, WHERE clause or None)
VIEWS = {
    "customer_raw": ("customer JOIN nation ON c_nationkey = n_nationkey", CUSTOMER_RAW, None),
    "sales_raw": ("orders JOIN lineitem ON o_orderkey = l_orderkey", SALES_RAW, None),
    "calendar": ("orders", CALENDAR, None),
    "coolers_raw": ("orders JOIN lineitem ON o_orderkey = l_orderkey", COOLERS_RAW, None),
    "demographics_raw": ("customer", DEMOGRAPHICS_RAW, None),
    "predictions": ("customer", PREDICTIONS, None),
    "commit_log": ("events", COMMIT_LOG, None),
}
DISTINCT_VIEWS = {"calendar"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark DataFrame for one mapping view (column pruning reaches the scan)."""
    _, cols, where = VIEWS[name]
    if name == "customer_raw":
        base = table(spark, sf_dir, "customer").join(
            table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    elif name in ("sales_raw", "coolers_raw"):
        base = table(spark, sf_dir, "orders").join(
            table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    elif name in ("calendar",):
        base = table(spark, sf_dir, "orders")
    elif name == "commit_log":
        base = table(spark, sf_dir, "events")
    else:
        base = table(spark, sf_dir, "customer")
    if where:
        base = base.filter(F.expr(where))
    out = base.selectExpr(*[f"{expr} AS `{c}`" for c, expr in cols.items()])
    return out.distinct() if name in DISTINCT_VIEWS else out


def view_sql(name: str) -> str:
    """The same view as a SQL SELECT (used by the DuckDB oracle)."""
    frm, cols, where = VIEWS[name]
    sel = ",\n  ".join(f'{expr} AS "{c}"' for c, expr in cols.items())
    distinct = "DISTINCT " if name in DISTINCT_VIEWS else ""
    sql = f"SELECT {distinct}\n  {sel}\nFROM {frm}"
    return sql + (f"\nWHERE {where}" if where else "")


def with_views(*names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS (\n{view_sql(n)}\n)" for n in names)
