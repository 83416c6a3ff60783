"""Source feature builders: coolers, demographics, customer master, sales.

Each builder is a function of DataFrames and parameters. The latest period and
the window's bounds are read in one small job each, so that filters carry
literals that reach the scan; tables that later steps read again (calendar
days, monthly sales) are written once.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outletlab import conf
from outletlab.functions import scalar as S
from outletlab.plans.joins import broadcast_counted
from outletlab.session import cut_lineage
from outletlab.spec import FeatureSpec, apply_specs, conjunction

# ------------------------------------------------------------------ coolers

COOLER_PROJECTION = [
    "CUSTOMER AS CUSTOMER",
    "EQUIPMENT AS EQUIPMENT",
    "TRY_CAST(FISCPER AS INT) AS FISCPER",
    "TRY_CAST(CUSTOMERS_WITH_COOLERS AS INT) AS CUSTOMER_WITH_COOLERS",
    "DF_STATUS_D",
    "TRY_CAST(ACTUAL_DOORS AS DECIMAL(38,1)) AS ACTUAL_DOORS",
]


def latest_cooler_period(raw: DataFrame) -> DataFrame:
    """One-row frame: the newest fiscal period present in the cooler data."""
    return raw.select(F.max(F.col("FISCPER").try_cast("int")).alias("FISCPER"))


def scalar_value(one_row: DataFrame):
    """The single value of a one-row, one-column aggregate (one small job).
    Used for the data-determined scalars of the original (latest period,
    window bounds) so later filters carry literals Spark can push down."""
    row = one_row.first()
    return None if row is None else row[0]


COOLER_FILTERS = [
    "TRY_CAST(CUSTOMERS_WITH_COOLERS AS INT) != 0",
    "DF_STATUS_D = 'placed'",
    "TRY_CAST(ACTUAL_DOORS AS DOUBLE) > 0",
    "TRY_CAST(FISCPER AS INT) = {period}",
]


def cooler_lines(raw: DataFrame, period=None, company_codes=None,
                 filters=COOLER_FILTERS) -> DataFrame:
    """Eligible cooler placements of the latest (or given) period, projected."""
    if company_codes is not None and "COMP_CODE" in raw.columns:
        raw = raw.filter(F.col("COMP_CODE").isin(list(company_codes)))
    if period is None:
        period = scalar_value(latest_cooler_period(raw))
    # Filter on raw columns before the projection so the predicates sit next to the scan.
    return raw.filter(conjunction(filters, {"period": period})).selectExpr(*COOLER_PROJECTION)


def cooler_features(raw: DataFrame, period=None, company_codes=None) -> DataFrame:
    """Doors and equipment count per customer over distinct
    (customer, equipment, doors) rows.

    Written as two partial-aggregated group-bys, (customer, equipment) then
    customer, instead of DISTINCT + count(DISTINCT): two exchanges, each with a
    map-side combine, and a hot customer is spread over its equipment first.
    """
    lines = cooler_lines(raw, period, company_codes)
    per_equipment = lines.groupBy("CUSTOMER", "EQUIPMENT").agg(
        F.sum_distinct("ACTUAL_DOORS").alias("doors"))
    return per_equipment.groupBy("CUSTOMER").agg(
        F.sum("doors").alias("COOLER_DOORS_SUM"),
        F.count("EQUIPMENT").alias("COOLER_EQUIP_COUNT"),
    )


# ------------------------------------------------------------- demographics

DEMOGRAPHIC_STRING_COLUMNS = ["CUSTOMER", "TAA_TC", "urbanicity", "CUSTOMER_DESC", "_BIC_CTRADE_CH",
                              "_BIC_CDMD_AREA", "geometry"]


def demographic_specs(literal_seasonal: bool = False) -> list:
    """Feature specs of the demographic source (order = dependency order)."""
    share = "coalesce(round(try_divide({field01}, {field02}), 2), 0)"
    rel = "coalesce(round(try_divide({field01} - {field02}, {field02}), 2), 0)"
    season = ("{field01} + {field02} + {field03} / 3" if literal_seasonal
              else "({field01} + {field02} + {field03}) / 3")
    density = f"try_divide({{field01}}, {conf.PI_APPROX} * {{field02}} * {{field02}})"
    specs = [FeatureSpec(f"Percentage_{c}", (c, "pop_sum"), share) for c in conf.AGE_GROUP_COLUMNS]
    specs += [
        FeatureSpec("wvce_01_pc", ("wvce_01_sum", "pop_sum"), "try_divide({field01}, {field02})"),
        FeatureSpec("wvce_02_pc", ("wvce_02_sum", "pop_sum"), "try_divide({field01}, {field02})"),
        FeatureSpec("TF_WINTER", tuple(conf.WINTER_TRAFFIC_COLUMNS), season),
        FeatureSpec("TF_SUMMER", tuple(conf.SUMMER_TRAFFIC_COLUMNS), season),
        FeatureSpec("Season_traffic_perc_diff", ("TF_SUMMER", "TF_WINTER"), rel),
        FeatureSpec("Weekend_traffic_perc_diff",
                    ("monthly_traffic_weekend_avg_mean", "monthly_traffic_weekday_avg_mean"), rel),
    ]
    specs += [FeatureSpec(f"Percentage_{c}", (c, "monthly_traffic_avg_mean"), share)
              for c in conf.TRAFFIC_HOUR_COLUMNS]
    specs += [
        FeatureSpec("population_density", ("pop_sum", "ta_size"), density),
        FeatureSpec("competitor_count_density", ("competitor_count", "ta_size"), density),
    ]
    return specs


def demographic_features(raw: DataFrame, literal_seasonal: bool = False) -> DataFrame:
    """Typed demographics (every measure as double) plus derived shares,
    per-capita values, seasonal levels, relative differences and densities."""
    typed = {c: f"TRY_CAST(`{c}` AS DOUBLE)" for c in raw.columns if c not in DEMOGRAPHIC_STRING_COLUMNS}
    return apply_specs(raw, demographic_specs(literal_seasonal), base=typed)


def demographic_numeric_columns(demographics: DataFrame) -> list:
    """Columns the nearest-outlet imputation treats as numeric measures."""
    return [c for c in demographics.columns
            if c not in conf.DEMOGRAPHIC_NON_NUMERIC and c != "CUSTOMER"]


# ---------------------------------------------------------- customer master

CUSTOMER_FILTERS = [
    "SALESORG IN ({sales_orgs})",
    "ACCNT_GRP IN ({account_groups})",
    "CUST_HIE02 IN ({hierarchy})",
    "(_BIC_CSUP_CUST IN ({order_blocks}) OR _BIC_CSUP_CUST IS NULL)",
    "_BIC_CTRADE_CH NOT IN ({excluded_channels})",
    "ERDAT <= {created_by}",
]


def add_months(d: _dt.date, months: int) -> _dt.date:
    """Calendar month arithmetic on a parameter date (day clamped to the
    month's length), so the cut-off is a literal in the predicate."""
    import calendar

    y, m = divmod(d.year * 12 + (d.month - 1) + months, 12)
    return _dt.date(y, m + 1, min(d.day, calendar.monthrange(y, m + 1)[1]))


def customer_eligibility(sales_orgs, account_groups, as_of: _dt.date, months_created: int = 3,
                         filters=CUSTOMER_FILTERS):
    params = {
        "sales_orgs": list(sales_orgs), "account_groups": list(account_groups),
        "hierarchy": conf.CUST_HIER2_LIST, "order_blocks": conf.ORDER_BLOCK_LIST,
        "excluded_channels": conf.EXCLUDED_TRADE_CHANNELS,
        "created_by": add_months(as_of, -months_created).strftime("%Y%m%d"),
    }
    return conjunction(filters, params)


def customer_features(raw: DataFrame, sales_orgs, account_groups, as_of: _dt.date,
                      months_created: int = 3, fill_unknown: bool = True) -> DataFrame:
    """Eligible customers with renamed attributes, routing flag, class group
    (the label) and typed coordinates."""
    df = raw.filter(customer_eligibility(sales_orgs, account_groups, as_of, months_created))
    source = {new: old for old, new in conf.CUSTOMER_RENAMES.items()}
    derived = {
        "CUST_ROUTED": S.routed_flag(source["ORDER_BLOCK_ID"]),
        "CUST_CCAF_GROUP": S.ccaf_group(F.substring(F.col("_BIC_C_CCAF").cast("string"), 2, 1)),
        "LONGITUDE": S.to_double("LONGITUDE"),
        "LATITUDE": S.to_double("LATITUDE"),
    }
    types = dict(raw.dtypes)
    cols = []
    for name in conf.CUSTOMER_COLUMNS:  # one projection: rename, derive, fill
        expr = derived.get(name, F.col(source.get(name, name)))
        is_text = name == "CUST_CCAF_GROUP" or types.get(source.get(name, name)) == "string"
        if fill_unknown and name.startswith("CUST_") and is_text:
            expr = F.coalesce(expr, F.lit("UNKNOWN"))
        cols.append(expr.alias(name))
    return df.select(*cols)


# -------------------------------------------------------------------- sales

SALES_LINE_SPECS = [
    FeatureSpec("MATERIAL", ("MATERIAL",), "CAST(TRY_CAST({field01} AS BIGINT) AS STRING)"),
    FeatureSpec("Direct_Sales_Volume_in_UC", ("FIELDNM013",), "TRY_CAST({field01} AS DECIMAL(38,3))"),
    FeatureSpec("Indirect_Sales_NSR", ("FIELDNM016",), "TRY_CAST({field01} AS DECIMAL(38,2))"),
    FeatureSpec("Indirect_Sales_Volume_in_UC", ("FIELDNM017",), "TRY_CAST({field01} AS DECIMAL(38,3))"),
    FeatureSpec("Direct_Sales_NSR", ("FIELDNM018",), "TRY_CAST({field01} AS DECIMAL(38,2))"),
]


SALES_FILTERS = ["CUSTOMER IS NOT NULL"]


def sales_lines(raw: DataFrame, calendar: DataFrame, sales_orgs=None, filters=SALES_FILTERS) -> DataFrame:
    """Typed sales lines with the fiscal period looked up in the calendar."""
    df = raw.filter(conjunction(filters))
    if sales_orgs is not None and "SALESORG" in raw.columns:
        df = df.filter(F.col("SALESORG").isin(list(sales_orgs)))
    df = apply_specs(df, SALES_LINE_SPECS).withColumnRenamed("FIELDNM005", "CURRENCY").drop("FISCPER")
    # one row a day: bounded by the calendar, whatever the size of the sales
    days = broadcast_counted(calendar.select("CALDAY", "FISCPER").distinct(), "calendar_days", required=True)
    return df.join(days, on="CALDAY", how="left").select(
        "CUSTOMER", "CALDAY", "FISCPER", "MATERIAL", "Direct_Sales_Volume_in_UC",
        "Indirect_Sales_Volume_in_UC", "Direct_Sales_NSR", "Indirect_Sales_NSR", "CURRENCY")


def latest_fiscal_period(lines: DataFrame) -> DataFrame:
    """One row: the newest period whose last sale day is more than 20 days
    after the month start or on the month start itself.

    A group-by on the period (map-side combined, one row per period) replaces
    the per-row window + DISTINCT of the original.
    """
    # yyyyMMdd days compare as integers: a hash aggregate, not a sort on strings
    per = lines.groupBy("FISCPER").agg(F.max(F.col("CALDAY").try_cast("int")).alias("last_day"))
    return _latest_qualifying(per)


def _latest_qualifying(per: DataFrame) -> DataFrame:
    days = S.days_since_month_start(S.yyyymmdd_to_date(F.col("last_day").cast("string")))
    ok = (days > conf.PERIOD_MIN_DAYS) | (days == 0)
    return per.filter(ok).agg(F.max("FISCPER").alias("FISCPER"))


def period_window(latest_period_col, months_back: int = conf.SALES_MONTHS_BACK):
    start = S.fiscal_period_shift(latest_period_col, -months_back).cast("int")
    return start, latest_period_col.cast("int")


def window_bounds(latest: DataFrame, months_back: int = conf.SALES_MONTHS_BACK):
    """(lo, hi) integer period bounds, computed in one small job from the
    one-row latest-period frame."""
    start, end = period_window(F.col("FISCPER"), months_back)
    row = latest.select(start.alias("lo"), end.alias("hi")).first()
    lo, hi = (row["lo"], row["hi"]) if row is not None else (None, None)
    return F.lit(lo).cast("int"), F.lit(hi).cast("int")


def sales_in_window(lines: DataFrame, months_back: int = conf.SALES_MONTHS_BACK) -> DataFrame:
    """Lines of the last ``months_back + 1`` fiscal periods (inclusive)."""
    lo, hi = window_bounds(latest_fiscal_period(lines), months_back)
    return lines.filter(F.col("FISCPER").try_cast("int").between(lo, hi))


def sales_amounts(lines: DataFrame) -> DataFrame:
    """Direct + indirect volume and revenue (missing parts count as 0)."""
    return lines.select(
        "CUSTOMER", "CALDAY", "FISCPER", "MATERIAL",
        S.zero_default_sum("Direct_Sales_Volume_in_UC", "Indirect_Sales_Volume_in_UC",
                           "decimal(38,3)").alias("Sales_Volume_in_UC"),
        S.zero_default_sum("Direct_Sales_NSR", "Indirect_Sales_NSR", "decimal(38,2)").alias("Sales_NSR"),
        "CURRENCY",
    )


def impute_unique_currency(lines: DataFrame, materialize: bool = True) -> DataFrame:
    """Customers with exactly one known currency get it on lines without one;
    remaining gaps become 'NA'. With ``materialize`` the lines are made once and
    stored in two directories, by whether the currency is known: the known part
    is passed on as it is (and two of its columns give the customers'
    currencies), only the gaps are joined. Without it the lines are made three
    times."""
    names = lines.columns
    if materialize:
        lines = cut_lineage(lines.withColumn("currency_known", F.col("CURRENCY").isNotNull()), "currency_lines", "currency_known")
        known, gaps = (lines.filter(F.col("currency_known") == part).select(*names) for part in (True, False))
    else:
        known, gaps = lines.filter("CURRENCY IS NOT NULL"), lines.filter("CURRENCY IS NULL")
    unique = (known.groupBy("CUSTOMER")
              .agg(F.min("CURRENCY").alias("UNIQUE_CURRENCY"), F.max("CURRENCY").alias("last_currency"))
              .filter("UNIQUE_CURRENCY = last_currency").drop("last_currency"))
    filled = gaps.join(unique, on="CUSTOMER", how="left").withColumn("CURRENCY", F.coalesce("UNIQUE_CURRENCY", F.lit("NA")))
    return known.unionByName(filled.select(*names))


SALES_VOLUME_MEAN = "Sales_Volume_in_UC_rolling_xmonths_back_avg"
SALES_NSR_MEAN = "Sales_NSR_rolling_xmonths_back_avg"


def monthly_sales(amounts: DataFrame) -> DataFrame:
    """One row per (customer, fiscal period): sums, line count and the last
    sale day of that customer in that period."""
    return amounts.groupBy("CUSTOMER", "FISCPER").agg(
        F.sum("Sales_Volume_in_UC").alias("volume_month"),
        F.sum("Sales_NSR").alias("nsr_month"),
        F.count(F.lit(1)).alias("lines_month"),
        F.max(F.col("CALDAY").try_cast("int")).alias("last_day"),
    )


def latest_period_of_months(monthly: DataFrame) -> DataFrame:
    """Same rule as ``latest_fiscal_period`` applied to the monthly table
    (the last day of a period is the max of its customers' last days)."""
    return _latest_qualifying(monthly.groupBy("FISCPER").agg(F.max("last_day").alias("last_day")))


def sales_features(amounts: DataFrame, weighting: str = "line", monthly: DataFrame | None = None) -> DataFrame:
    """Mean monthly volume and revenue per customer.

    ``weighting='line'`` (default) reproduces the original per-line window
    average: every line carries its month's sum, so the mean is
    sum(n_m * S_m) / sum(n_m). ``'month'`` is the plain mean of monthly sums.
    Both are two map-side-combined group-bys (customer-month, then customer).
    """
    monthly = monthly_sales(amounts) if monthly is None else monthly
    if weighting == "line":
        n = F.col("lines_month")
        vol = F.sum(F.col("volume_month") * n).cast("double") / F.sum(n).cast("double")
        nsr = F.sum(F.col("nsr_month") * n).cast("double") / F.sum(n).cast("double")
    elif weighting == "month":
        cnt = F.count(F.lit(1)).cast("double")
        vol = F.sum("volume_month").cast("double") / cnt
        nsr = F.sum("nsr_month").cast("double") / cnt
    else:
        raise ValueError(f"unknown weighting {weighting!r}")
    return monthly.groupBy("CUSTOMER").agg(vol.alias(SALES_VOLUME_MEAN), nsr.alias(SALES_NSR_MEAN))


def sales_pipeline(raw: DataFrame, calendar: DataFrame, sales_orgs=None,
                   months_back: int = conf.SALES_MONTHS_BACK, weighting: str = "line",
                   materialize: bool = True) -> DataFrame:
    """Sales source end to end with a single scan of the sales lines.

    Lines are aggregated once to (customer, period) rows that keep the last
    sale day; the latest qualifying period and the window filter are then
    applied to that monthly table. With ``materialize`` the monthly table
    (customers x periods, orders of magnitude smaller than the lines) is
    written once to the shared checkpoint folder, so the largest table is
    read once instead of twice (once for the latest period, once for the
    features). Without it, Catalyst pushes the window filter below the
    aggregation and the lines are scanned by both the subquery and the
    main plan.
    """
    monthly = monthly_sales(sales_amounts(sales_lines(raw, calendar, sales_orgs)))
    if materialize:
        monthly = cut_lineage(monthly, "sales_monthly")
    lo, hi = window_bounds(latest_period_of_months(monthly), months_back)
    in_window = monthly.filter(F.col("FISCPER").try_cast("int").between(lo, hi))
    return sales_features(None, weighting, monthly=in_window)
