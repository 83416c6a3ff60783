"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code (plain SQL over the same fixture
views). Only fixed values and run parameters are shared.
"""

from __future__ import annotations

from outletlab import conf
from outletlab.checks import params as P
from outletlab.sources.fixtures import DEMOGRAPHICS_RAW, with_views

STRING_DEMOGRAPHICS = ["CUSTOMER", "TAA_TC", "urbanicity", "CUSTOMER_DESC", "_BIC_CTRADE_CH",
                       "_BIC_CDMD_AREA", "geometry"]


def q(name: str) -> str:
    return f'"{name}"'


def lit(v) -> str:
    if isinstance(v, (list, tuple)):
        return ", ".join(lit(x) for x in v)
    return "'" + str(v).replace("'", "''") + "'"


def div(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END)"


# ------------------------------------------------------------------ customer

def customer_select(as_of) -> str:
    fill = lambda e, n: f"coalesce({e}, 'UNKNOWN') AS {n}"
    ccaf = ("CASE substr(_BIC_C_CCAF, 2, 1) WHEN '1' THEN 'Platinum' WHEN '2' THEN 'Gold' "
            "WHEN '3' THEN 'Silver' WHEN '4' THEN 'Bronze' WHEN '5' THEN 'Iron' ELSE 'Other' END")
    return f"""
SELECT CUSTOMER,
  {fill('_BIC_CTRADE_CH', 'CUST_CTRADE_CH')}, {fill('CTRADE_CH_DESC', 'CUST_CTRADE_CH_DESC')},
  {fill('_BIC_CSUB_TRAD', 'CUST_CSUB_TRAD')}, {fill('CSUB_TRAD_DESC', 'CUST_CSUB_TRAD_DESC')},
  {fill('CUST_GRP4', 'CUST_GRP4')}, {fill('CUST_GRP4_DESC', 'CUST_GRP4_DESC')},
  {fill('_BIC_CDMD_AREA', 'CUST_CDMD_AREA')}, {fill('CDMD_AREA_DESC', 'CUST_CDMD_AREA_DESC')},
  CASE WHEN _BIC_CSUP_CUST = 'NR' THEN 0 ELSE 1 END AS CUST_ROUTED,
  {fill(ccaf, 'CUST_CCAF_GROUP')},
  POSTAL_CD AS POSTAL_CODE,
  TRY_CAST(LONGITUDE AS DOUBLE) AS LONGITUDE, TRY_CAST(LATITUDE AS DOUBLE) AS LATITUDE
FROM customer_raw
WHERE SALESORG IN ({lit(P.SALES_ORGS)}) AND ACCNT_GRP IN ({lit(P.ACCOUNT_GROUPS)})
  AND CUST_HIE02 IN ({lit(conf.CUST_HIER2_LIST)})
  AND (_BIC_CSUP_CUST IN ({lit(conf.ORDER_BLOCK_LIST)}) OR _BIC_CSUP_CUST IS NULL)
  AND _BIC_CTRADE_CH NOT IN ({lit(conf.EXCLUDED_TRADE_CHANNELS)})
  AND ERDAT <= strftime(DATE '{as_of.isoformat()}' - INTERVAL 3 MONTH, '%Y%m%d')"""


def customer_master() -> str:
    return with_views("customer_raw") + customer_select(P.AS_OF)


# ------------------------------------------------------------------- coolers

COOLER_CTES = f"""
cooler_latest AS (SELECT max(TRY_CAST(FISCPER AS INT)) AS p FROM coolers_raw),
cooler_lines AS (
  SELECT DISTINCT CUSTOMER, EQUIPMENT, TRY_CAST(ACTUAL_DOORS AS DECIMAL(38,1)) AS ACTUAL_DOORS
  FROM coolers_raw, cooler_latest
  WHERE COMP_CODE IN ({lit(P.COMPANY_CODES)})
    AND TRY_CAST(CUSTOMERS_WITH_COOLERS AS INT) <> 0 AND DF_STATUS_D = 'placed'
    AND TRY_CAST(ACTUAL_DOORS AS DOUBLE) > 0 AND TRY_CAST(FISCPER AS INT) = cooler_latest.p),
cooler_feat AS (
  SELECT CUSTOMER, sum(ACTUAL_DOORS) AS COOLER_DOORS_SUM, count(DISTINCT EQUIPMENT) AS COOLER_EQUIP_COUNT
  FROM cooler_lines GROUP BY CUSTOMER)"""


def cooler_features() -> str:
    return with_views("coolers_raw") + "," + COOLER_CTES + "\nSELECT * FROM cooler_feat"


# -------------------------------------------------------------- demographics

def demographic_select(literal_seasonal: bool = False) -> str:
    cols = []
    for c in DEMOGRAPHICS_RAW:
        cols.append(q(c) if c in STRING_DEMOGRAPHICS else f"TRY_CAST({q(c)} AS DOUBLE) AS {q(c)}")
    base = "SELECT " + ", ".join(cols) + " FROM demographics_raw"
    share = lambda a, b: f"(coalesce(round({div(q(a), q(b))}, 2), 0) + 0.0)"
    w, s = conf.WINTER_TRAFFIC_COLUMNS, conf.SUMMER_TRAFFIC_COLUMNS
    if literal_seasonal:
        tf = lambda x: f"{q(x[0])} + {q(x[1])} + {q(x[2])} / 3"
    else:
        tf = lambda x: f"({q(x[0])} + {q(x[1])} + {q(x[2])}) / 3"
    d1 = ["*"]
    d1 += [f"{share(c, 'pop_sum')} AS {q('Percentage_' + c)}" for c in conf.AGE_GROUP_COLUMNS]
    d1 += [f"{div(q('wvce_01_sum'), q('pop_sum'))} AS wvce_01_pc",
           f"{div(q('wvce_02_sum'), q('pop_sum'))} AS wvce_02_pc",
           f"{tf(w)} AS TF_WINTER", f"{tf(s)} AS TF_SUMMER"]
    d2 = ["*",
          f"(coalesce(round({div('TF_SUMMER - TF_WINTER', 'TF_WINTER')}, 2), 0) + 0.0) AS Season_traffic_perc_diff",
          ("(coalesce(round(" + div("monthly_traffic_weekend_avg_mean - monthly_traffic_weekday_avg_mean",
                                    "monthly_traffic_weekday_avg_mean") + ", 2), 0) + 0.0) AS Weekend_traffic_perc_diff")]
    d2 += [f"{share(c, 'monthly_traffic_avg_mean')} AS {q('Percentage_' + c)}" for c in conf.TRAFFIC_HOUR_COLUMNS]
    d2 += [f"{div('pop_sum', f'{conf.PI_APPROX} * ta_size * ta_size')} AS population_density",
           f"{div('competitor_count', f'{conf.PI_APPROX} * ta_size * ta_size')} AS competitor_count_density"]
    return (f"SELECT {', '.join(d2)} FROM (SELECT {', '.join(d1)} FROM ({base}) d0) d1")


def demographic_features() -> str:
    return with_views("demographics_raw") + "\n" + demographic_select()


# --------------------------------------------------------------------- sales

SALES_CTES = f"""
sales_days AS (SELECT DISTINCT CALDAY, FISCPER FROM calendar),
lines AS (
  SELECT s.CUSTOMER, s.CALDAY, d.FISCPER, CAST(TRY_CAST(s.MATERIAL AS BIGINT) AS VARCHAR) AS MATERIAL,
    TRY_CAST(s.FIELDNM013 AS DECIMAL(38,3)) AS dvol, TRY_CAST(s.FIELDNM017 AS DECIMAL(38,3)) AS ivol,
    TRY_CAST(s.FIELDNM018 AS DECIMAL(38,2)) AS dnsr, TRY_CAST(s.FIELDNM016 AS DECIMAL(38,2)) AS insr,
    s.FIELDNM005 AS CURRENCY
  FROM sales_raw s LEFT JOIN sales_days d ON s.CALDAY = d.CALDAY
  WHERE s.CUSTOMER IS NOT NULL AND s.SALESORG IN ({lit(P.SALES_ORGS)})),
period_days AS (
  SELECT FISCPER, date_diff('day', date_trunc('month', strptime(max(CALDAY), '%Y%m%d')),
                            strptime(max(CALDAY), '%Y%m%d')) AS ndays
  FROM lines GROUP BY FISCPER),
latest AS (SELECT max(FISCPER) AS p FROM period_days WHERE ndays > {conf.PERIOD_MIN_DAYS} OR ndays = 0),
bounds AS (
  SELECT p, CAST(strftime(make_date(CAST(substr(p, 1, 4) AS INT), CAST(substr(p, 6, 2) AS INT), 1)
                          - INTERVAL {conf.SALES_MONTHS_BACK} MONTH, '%Y0%m') AS INT) AS lo,
         CAST(p AS INT) AS hi
  FROM latest),
amounts AS (
  SELECT l.CUSTOMER, l.CALDAY, l.FISCPER, l.MATERIAL,
    coalesce(dvol, CAST(0 AS DECIMAL(38,3))) + coalesce(ivol, CAST(0 AS DECIMAL(38,3))) AS Sales_Volume_in_UC,
    coalesce(dnsr, CAST(0 AS DECIMAL(38,2))) + coalesce(insr, CAST(0 AS DECIMAL(38,2))) AS Sales_NSR,
    l.CURRENCY
  FROM lines l JOIN bounds b ON TRY_CAST(l.FISCPER AS INT) BETWEEN b.lo AND b.hi),
monthly AS (
  SELECT CUSTOMER, FISCPER, sum(Sales_Volume_in_UC) AS vm, sum(Sales_NSR) AS nm, count(*) AS n
  FROM amounts GROUP BY CUSTOMER, FISCPER),
sales_feat AS (
  SELECT CUSTOMER,
    CAST(sum(vm * n) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS Sales_Volume_in_UC_rolling_xmonths_back_avg,
    CAST(sum(nm * n) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS Sales_NSR_rolling_xmonths_back_avg
  FROM monthly GROUP BY CUSTOMER)"""


def _sales(tail: str) -> str:
    return with_views("sales_raw", "calendar") + "," + SALES_CTES + "\n" + tail


def latest_fiscal_period() -> str:
    return _sales("SELECT p AS FISCPER_LATEST, CAST(lo AS VARCHAR) AS FISCPER_START FROM bounds")


def sales_lines() -> str:
    return _sales("SELECT * FROM amounts")


def currency_impute() -> str:
    return _sales("""
, uniq AS (
  SELECT CUSTOMER, min(CURRENCY) AS u FROM amounts WHERE CURRENCY IS NOT NULL
  GROUP BY CUSTOMER HAVING count(DISTINCT CURRENCY) = 1)
SELECT a.CUSTOMER, a.CALDAY, a.FISCPER, a.MATERIAL, a.Sales_Volume_in_UC, a.Sales_NSR,
       coalesce(a.CURRENCY, uniq.u, 'NA') AS CURRENCY
FROM amounts a LEFT JOIN uniq ON a.CUSTOMER = uniq.CUSTOMER""")


def sales_features() -> str:
    return _sales("SELECT * FROM sales_feat")


def sales_features_monthly() -> str:
    return _sales("""SELECT CUSTOMER,
  CAST(sum(vm) AS DOUBLE) / count(*) AS Sales_Volume_in_UC_rolling_xmonths_back_avg,
  CAST(sum(nm) AS DOUBLE) / count(*) AS Sales_NSR_rolling_xmonths_back_avg
FROM monthly GROUP BY CUSTOMER""")


ORACLE = {
    "customer_master": customer_master,
    "cooler_features": cooler_features,
    "demographic_features": demographic_features,
    "latest_fiscal_period": latest_fiscal_period,
    "sales_lines": sales_lines,
    "currency_impute": currency_impute,
    "sales_features": sales_features,
    "sales_features_monthly": sales_features_monthly,
}


# ------------------------------------------------- star join and imputations

def _demo_columns() -> list:
    cols = list(DEMOGRAPHICS_RAW)
    cols += [f"Percentage_{c}" for c in conf.AGE_GROUP_COLUMNS]
    cols += ["wvce_01_pc", "wvce_02_pc", "TF_WINTER", "TF_SUMMER", "Season_traffic_perc_diff",
             "Weekend_traffic_perc_diff"]
    cols += [f"Percentage_{c}" for c in conf.TRAFFIC_HOUR_COLUMNS]
    cols += ["population_density", "competitor_count_density"]
    return cols


DEMO_COLUMNS = _demo_columns()
DEMO_NUMERIC = [c for c in DEMO_COLUMNS if c not in conf.DEMOGRAPHIC_NON_NUMERIC and c != "CUSTOMER"]
STAR_COLUMNS = conf.CUSTOMER_COLUMNS + [c for c in DEMO_COLUMNS
                                        if c not in ("CUSTOMER", "LONGITUDE", "LATITUDE")]
CHECK_COLUMNS = DEMO_NUMERIC + ["LONGITUDE", "LATITUDE", "_BIC_CDMD_AREA", "CUSTOMER"]
COMPLETE = "(" + " AND ".join(f"{q(c)} IS NOT NULL" for c in CHECK_COLUMNS) + ")"
FILL_COLUMNS = DEMO_NUMERIC  # the area of a customer is never imputed


def star_ctes(p: str, as_of) -> str:
    """CTEs {p}cust, {p}demo, {p}star, {p}nn (nearest donor), {p}imp
    (nearest-imputed star)."""
    fill_sel = ", ".join(
        (f"coalesce(s.{q(c)}, dv.{q(c)}) AS {q(c)}" if c in FILL_COLUMNS else f"s.{q(c)}")
        for c in STAR_COLUMNS)
    return f"""
{p}cust AS ({customer_select(as_of)}),
{p}demo AS ({demographic_select()}),
{p}star AS (SELECT c.*, d.* EXCLUDE (CUSTOMER, LONGITUDE, LATITUDE)
            FROM {p}cust c LEFT JOIN {p}demo d ON c.CUSTOMER = d.CUSTOMER),
{p}qry AS (SELECT CUSTOMER, LATITUDE, LONGITUDE FROM {p}star
           WHERE NOT {COMPLETE} AND LATITUDE IS NOT NULL AND LONGITUDE IS NOT NULL),
{p}don AS (SELECT CUSTOMER AS DONOR, LATITUDE, LONGITUDE FROM {p}star WHERE {COMPLETE}),
{p}pairs AS (
  SELECT a.CUSTOMER, b.DONOR,
    sqrt((a.LATITUDE - b.LATITUDE) * (a.LATITUDE - b.LATITUDE)
         + (a.LONGITUDE - b.LONGITUDE) * (a.LONGITUDE - b.LONGITUDE)) * {conf.KM_PER_DEGREE} AS distance_km
  FROM {p}qry a, {p}don b),
{p}nn AS (
  SELECT CUSTOMER, DONOR, distance_km FROM (
    SELECT *, row_number() OVER (PARTITION BY CUSTOMER ORDER BY distance_km, DONOR) AS rn FROM {p}pairs) r
  WHERE rn = 1 AND distance_km < {conf.NEAREST_MAX_KM}),
{p}dv AS (SELECT CUSTOMER AS DONOR, * EXCLUDE (CUSTOMER) FROM {p}star WHERE {COMPLETE}),
{p}imp AS (
  SELECT {fill_sel}, nn.DONOR AS _donor
  FROM {p}star s LEFT JOIN {p}nn nn ON s.CUSTOMER = nn.CUSTOMER
  LEFT JOIN {p}dv dv ON nn.DONOR = dv.DONOR)"""


def nearest_outlet() -> str:
    return (with_views("customer_raw", "demographics_raw") + "," + star_ctes("", P.AS_OF)
            + "\nSELECT * FROM nn")


def impute_nearest() -> str:
    cols = ", ".join(q(c) for c in STAR_COLUMNS)
    return (with_views("customer_raw", "demographics_raw") + "," + star_ctes("", P.AS_OF)
            + f"\nSELECT {cols} FROM imp")


def impute_area_mean() -> str:
    means = ", ".join(f"avg({q(c)}) AS {q(c)}" for c in DEMO_NUMERIC)
    beyond = "i._donor IS NULL AND i.LATITUDE IS NOT NULL AND i.LONGITUDE IS NOT NULL"
    sel = []
    for c in STAR_COLUMNS:
        if c in DEMO_NUMERIC:
            sel.append(f"(round(CASE WHEN {beyond} THEN coalesce(i.{q(c)}, am.{q(c)}) ELSE i.{q(c)} END, 6)"
                       f" + 0.0) AS {q(c)}")
        else:
            sel.append(f"i.{q(c)}")
    return (with_views("customer_raw", "demographics_raw") + "," + star_ctes("", P.AS_OF) + f""",
am AS (SELECT _BIC_CDMD_AREA AS _area, {means} FROM star GROUP BY _BIC_CDMD_AREA)
SELECT {', '.join(sel)}
FROM imp i LEFT JOIN am ON am._area IS NOT DISTINCT FROM i._BIC_CDMD_AREA""")


def hierarchical_ctes(src: str, p: str) -> str:
    """{p}hf / {p}hc / {p}ho group means of the two sales means over ``src``."""
    v, n = "Sales_Volume_in_UC_rolling_xmonths_back_avg", "Sales_NSR_rolling_xmonths_back_avg"
    return f"""
{p}hf AS (SELECT CUST_CTRADE_CH_DESC AS _ch, CUST_CDMD_AREA AS _ar, avg({v}) AS fv, avg({n}) AS fn
          FROM {src} GROUP BY CUST_CTRADE_CH_DESC, CUST_CDMD_AREA),
{p}hc AS (SELECT CUST_CTRADE_CH_DESC AS _ch, avg({v}) AS cv, avg({n}) AS cn
          FROM {src} GROUP BY CUST_CTRADE_CH_DESC),
{p}ho AS (SELECT avg({v}) AS ov, avg({n}) AS onn FROM {src})"""


def hierarchical_join(alias: str, p: str) -> str:
    return (f"LEFT JOIN {p}hf hf ON hf._ch IS NOT DISTINCT FROM {alias}.CUST_CTRADE_CH_DESC "
            f"AND hf._ar IS NOT DISTINCT FROM {alias}.CUST_CDMD_AREA "
            f"LEFT JOIN {p}hc hc ON hc._ch IS NOT DISTINCT FROM {alias}.CUST_CTRADE_CH_DESC "
            f"CROSS JOIN {p}ho ho")


IMPUTED_VOLUME = ("(round(coalesce(Sales_Volume_in_UC_rolling_xmonths_back_avg, hf.fv, hc.cv, ho.ov, 0), 6) + 0.0)"
                  " AS Sales_Volume_in_UC_imputed")
IMPUTED_NSR = ("(round(coalesce(Sales_NSR_rolling_xmonths_back_avg, hf.fn, hc.cn, ho.onn, 0), 6) + 0.0)"
               " AS Sales_NSR_imputed")


def impute_hierarchical() -> str:
    return (with_views("customer_raw", "sales_raw", "calendar") + "," + SALES_CTES + f""",
cust AS ({customer_select(P.AS_OF)}),
h AS (SELECT c.CUSTOMER, c.CUST_CTRADE_CH_DESC, c.CUST_CDMD_AREA, s.Sales_Volume_in_UC_rolling_xmonths_back_avg,
             s.Sales_NSR_rolling_xmonths_back_avg
      FROM cust c LEFT JOIN sales_feat s ON c.CUSTOMER = s.CUSTOMER),""" + hierarchical_ctes("h", "") + f"""
SELECT h.*, {IMPUTED_VOLUME}, {IMPUTED_NSR}
FROM h {hierarchical_join('h', '')}""")


def abt_ctes(p: str, as_of) -> str:
    """CTEs ending in {p}abt: the base table for one as-of date (rounded
    sales means, see queries.round_means)."""
    star_cols = ", ".join(f"i.{q(c)}" for c in STAR_COLUMNS)
    out_cols = ", ".join(q(c) for c in conf.ABT_COLUMNS)
    return star_ctes(p, as_of) + f""",
{p}joined AS (
  SELECT {star_cols}, cf.COOLER_DOORS_SUM, cf.COOLER_EQUIP_COUNT,
         sf.Sales_Volume_in_UC_rolling_xmonths_back_avg, sf.Sales_NSR_rolling_xmonths_back_avg
  FROM {p}imp i LEFT JOIN cooler_feat cf ON i.CUSTOMER = cf.CUSTOMER
  LEFT JOIN sales_feat sf ON i.CUSTOMER = sf.CUSTOMER),""" + hierarchical_ctes(f"{p}joined", p) + f""",
{p}abt AS (
  SELECT {out_cols} FROM (
    SELECT f.*, {IMPUTED_VOLUME}, {IMPUTED_NSR}
    FROM {p}joined f {hierarchical_join('f', p)}) x)"""


def _abt_views() -> str:
    return (with_views("customer_raw", "demographics_raw", "coolers_raw", "sales_raw", "calendar")
            + "," + COOLER_CTES + "," + SALES_CTES)


def abt() -> str:
    return _abt_views() + "," + abt_ctes("", P.AS_OF) + "\nSELECT * FROM abt"


def abt_incremental() -> str:
    return (_abt_views() + "," + abt_ctes("", P.AS_OF) + "," + abt_ctes("prev_", P.PREVIOUS_AS_OF)
            + f"""
SELECT *, '{P.PREVIOUS_PARDT}' AS pardt FROM prev_abt
UNION ALL
SELECT *, '{P.RUN_PARDT}' AS pardt FROM abt
WHERE CUSTOMER NOT IN (SELECT CUSTOMER FROM prev_abt)""")


ORACLE.update({
    "nearest_outlet": nearest_outlet,
    "impute_nearest": impute_nearest,
    "impute_area_mean": impute_area_mean,
    "impute_hierarchical": impute_hierarchical,
    "abt": abt,
    "abt_incremental": abt_incremental,
})


# ------------------------------------------------------ feature selection

LABEL = "CUST_CCAF_GROUP"


def _features() -> list:
    excluded = set(conf.FEATURE_SELECTION_EXCLUDED) | {LABEL}
    return [c for c in conf.ABT_COLUMNS if c not in excluded]


ABT_STRING = set(conf.CUSTOMER_COLUMNS) - {"CUST_ROUTED", "LONGITUDE", "LATITUDE"} | {
    "TAA_TC", "urbanicity"}


def chi_square_ctes() -> str:
    feats = _features()
    cat = lambda c: f"coalesce(CAST({q(c)} AS VARCHAR), '<NULL>')"
    wide = ", ".join([f"{cat(LABEL)} AS _label"] + [f"{cat(c)} AS {q(c)}" for c in feats])
    return _abt_views() + "," + abt_ctes("", P.AS_OF) + f""",
wide AS (SELECT {wide} FROM abt),
long AS (UNPIVOT wide ON {', '.join(q(c) for c in feats)} INTO NAME feature VALUE value),
cont AS (SELECT feature, value, _label, count(*) AS n FROM long GROUP BY feature, value, _label),
rm AS (SELECT feature, _label, sum(n) AS R FROM cont GROUP BY feature, _label),
cm AS (SELECT feature, value, sum(n) AS C FROM cont GROUP BY feature, value),
tot AS (SELECT feature, sum(R) AS N, count(*) AS r FROM rm GROUP BY feature),
ncat AS (SELECT feature, count(*) AS c FROM cm GROUP BY feature),
grid AS (
  SELECT cm.feature, CAST(rm.R AS DOUBLE) * cm.C / tot.N AS E, CAST(coalesce(cont.n, 0) AS DOUBLE) AS O
  FROM cm JOIN rm ON cm.feature = rm.feature JOIN tot ON cm.feature = tot.feature
  LEFT JOIN cont ON cont.feature = cm.feature AND cont.value = cm.value AND cont._label = rm._label),
stat AS (
  SELECT feature, sum((O - E) * (O - E) / E) AS plain,
         sum((abs(O - E) - least(0.5, abs(O - E))) * (abs(O - E) - least(0.5, abs(O - E))) / E) AS yates
  FROM grid GROUP BY feature),
chi AS (
  SELECT stat.feature, CAST((tot.r - 1) * (ncat.c - 1) AS BIGINT) AS dof,
    CASE WHEN (tot.r - 1) * (ncat.c - 1) = 1 THEN yates ELSE plain END AS chi2
  FROM stat JOIN tot ON stat.feature = tot.feature JOIN ncat ON stat.feature = ncat.feature)"""


def chi_square() -> str:
    return chi_square_ctes() + "\nSELECT feature, dof, round(chi2, 6) + 0.0 AS chi2 FROM chi"


def p_value_ctes() -> str:
    """p = 1 - P(dof/2, chi2/2), P by its power series
    sum_n exp((a + n) ln x - x - lgamma(a + n + 1)), taken well past its
    largest term (independent of the methods used on the Spark side)."""
    return chi_square_ctes() + f""",
series AS (
  SELECT feature, sum(exp((dof / 2.0 + t.n) * ln(chi2 / 2.0) - chi2 / 2.0 - lgamma(dof / 2.0 + t.n + 1))) AS lower_p
  FROM chi, (SELECT unnest(range(0, (SELECT CAST(max(chi2) + 50 * sqrt(max(chi2)) + 200 AS BIGINT) FROM chi))) AS n) t
  WHERE dof > 0 AND chi2 > 0 GROUP BY feature),
pv AS (
  SELECT chi.feature, chi.dof, chi.chi2,
    CASE WHEN chi.dof = 0 OR chi.chi2 <= 0 THEN 1.0 ELSE greatest(0.0, 1.0 - series.lower_p) END AS p
  FROM chi LEFT JOIN series ON chi.feature = series.feature)"""


def chi_square_selection() -> str:
    return p_value_ctes() + f"""
SELECT feature, round(chi2, 6) + 0.0 AS chi2, dof, round(p, 6) + 0.0 AS p_value,
       p < {conf.CHI_SQUARE_ALPHA} AS important
FROM pv"""


def _assoc_parts(feats, strings=None) -> str:
    numeric = [c for c in feats if c not in (ABT_STRING if strings is None else strings)]
    pairs = [(a, b) for i, a in enumerate(feats) for b in feats[i + 1:]]
    sqls = []
    for a, b in pairs:
        if a in numeric and b in numeric:
            sqls.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, 'pearson' AS kind, "
                        f"corr(CAST({q(a)} AS DOUBLE), CAST({q(b)} AS DOUBLE)) AS assoc FROM abt")
        elif a not in numeric and b not in numeric:
            sqls.append(f"""SELECT '{a}' AS feature_a, '{b}' AS feature_b, 'cramers_v' AS kind, (
  WITH x AS (SELECT CAST({q(a)} AS VARCHAR) AS va, CAST({q(b)} AS VARCHAR) AS vb FROM abt
             WHERE {q(a)} IS NOT NULL AND {q(b)} IS NOT NULL),
  ct AS (SELECT va, vb, count(*) AS n FROM x GROUP BY va, vb),
  ma AS (SELECT va, count(*) AS A FROM x GROUP BY va), mb AS (SELECT vb, count(*) AS B FROM x GROUP BY vb),
  t AS (SELECT count(*) AS T, count(DISTINCT va) AS ra, count(DISTINCT vb) AS rb FROM x),
  g AS (SELECT CAST(ma.A AS DOUBLE) * mb.B / t.T AS E, CAST(coalesce(ct.n, 0) AS DOUBLE) AS O
        FROM ma CROSS JOIN mb CROSS JOIN t LEFT JOIN ct ON ct.va = ma.va AND ct.vb = mb.vb)
  SELECT CASE WHEN least(ra, rb) > 1 THEN sqrt((SELECT sum((O - E) * (O - E) / E) FROM g)
                                            / (T * (least(ra, rb) - 1))) END FROM t) AS assoc""")
        else:
            c, y = (a, b) if a not in numeric else (b, a)
            sqls.append(f"""SELECT '{a}' AS feature_a, '{b}' AS feature_b, 'eta' AS kind, (
  WITH x AS (SELECT CAST({q(c)} AS VARCHAR) AS va, CAST({q(y)} AS DOUBLE) AS y FROM abt
             WHERE {q(c)} IS NOT NULL AND {q(y)} IS NOT NULL),
  g AS (SELECT count(*) AS n, avg(y) AS m FROM x GROUP BY va),
  t AS (SELECT avg(y) AS m, sum((y - (SELECT avg(y) FROM x)) * (y - (SELECT avg(y) FROM x))) AS sst FROM x)
  SELECT CASE WHEN t.sst > 0 THEN sqrt((SELECT sum(n * (g.m - t.m) * (g.m - t.m)) FROM g) / t.sst) END
  FROM t) AS assoc""")
    return "\nUNION ALL\n".join(sqls)


def association_matrix() -> str:
    return (_abt_views() + "," + abt_ctes("", P.AS_OF) + f""",
assoc AS ({_assoc_parts(_features())})
SELECT feature_a, feature_b, kind, round(CASE WHEN isnan(assoc) THEN NULL ELSE assoc END, 6) + 0.0 AS assoc
FROM assoc""")


def association_prune() -> str:
    feats = _features()
    order = ", ".join(f"('{f}', {i})" for i, f in enumerate(feats))
    return (_abt_views() + "," + abt_ctes("", P.AS_OF) + f""",
assoc AS ({_assoc_parts(feats)}),
r AS (SELECT feature_a, feature_b, round(CASE WHEN isnan(assoc) THEN NULL ELSE assoc END, 6) + 0.0 AS assoc
      FROM assoc),
o(feature, position) AS (VALUES {order}),
w AS (SELECT feature_b AS feature, max(assoc) AS max_prior_assoc FROM r GROUP BY feature_b)
SELECT o.feature, CAST(o.position AS INTEGER) AS position, w.max_prior_assoc,
       coalesce(w.max_prior_assoc > {conf.ASSOCIATION_THRESHOLD}, false) AS dropped
FROM o LEFT JOIN w ON o.feature = w.feature""")


def stratified_split() -> str:
    return with_views("customer_raw") + f""",
cust AS ({customer_select(P.AS_OF)}),
lab AS (SELECT CUSTOMER, CUST_CCAF_GROUP AS targetVar FROM cust WHERE CUST_CCAF_GROUP <> '{conf.LABEL_EXCLUDED}'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY targetVar ORDER BY coalesce(md5(CUSTOMER), ''), coalesce(CUSTOMER, '')) AS rn,
         count(*) OVER (PARTITION BY targetVar) AS cnt
  FROM lab)
SELECT CUSTOMER, targetVar, CASE WHEN rn <= floor({conf.TRAIN_FRACTION} * cnt) THEN 'train' ELSE 'test' END AS split
FROM ranked"""


ORACLE.update({
    "chi_square": chi_square,
    "chi_square_selection": chi_square_selection,
    "association_matrix": association_matrix,
    "association_prune": association_prune,
    "stratified_split": stratified_split,
})


# ------------------------------------------------------------- evaluation

def eval_ctes(label: str = "label", prediction: str = "prediction") -> str:
    return f""",
scored AS (SELECT *, {label} AS act, {prediction} AS pre FROM predictions WHERE labelName <> 'Other'),
cm AS (SELECT Holdout, act, pre, count(*) AS n FROM scored WHERE act IS NOT NULL AND pre IS NOT NULL GROUP BY Holdout, act, pre),
cls AS (SELECT Holdout, act AS class FROM cm UNION SELECT Holdout, pre FROM cm),
st AS (
  SELECT c.Holdout, c.class,
    coalesce((SELECT sum(n) FROM cm WHERE cm.Holdout IS NOT DISTINCT FROM c.Holdout AND act = c.class AND pre = c.class), 0) AS tp,
    coalesce((SELECT sum(n) FROM cm WHERE cm.Holdout IS NOT DISTINCT FROM c.Holdout AND act = c.class), 0) AS actual,
    coalesce((SELECT sum(n) FROM cm WHERE cm.Holdout IS NOT DISTINCT FROM c.Holdout AND pre = c.class), 0) AS predicted,
    (SELECT sum(n) FROM cm WHERE cm.Holdout IS NOT DISTINCT FROM c.Holdout) AS total
  FROM cls c),
st2 AS (
  SELECT *, CASE WHEN predicted > 0 THEN CAST(tp AS DOUBLE) / predicted ELSE 0.0 END AS prec,
            CASE WHEN actual > 0 THEN CAST(tp AS DOUBLE) / actual ELSE 0.0 END AS rec
  FROM st),
st3 AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END AS f1 FROM st2),
overall AS (
  SELECT Holdout, CAST(sum(tp) AS DOUBLE) / max(total) AS accuracy,
    sum(CAST(actual AS DOUBLE) / total * prec) AS weighted_precision,
    sum(CAST(actual AS DOUBLE) / total * rec) AS weighted_recall,
    sum(CAST(actual AS DOUBLE) / total * f1) AS weighted_f1
  FROM st3 GROUP BY Holdout),
ranked AS (SELECT Holdout, act, probability AS p FROM scored WHERE probability IS NOT NULL AND act IS NOT NULL),
rk AS (
  SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY Holdout, p) - 1) / 2.0 AS r, count(*) OVER (PARTITION BY Holdout) AS n_all
  FROM ranked WINDOW w AS (PARTITION BY Holdout ORDER BY p)),
auc AS (
  SELECT Holdout, act AS class, count(*) AS n_pos,
    CASE WHEN max(n_all) > count(*)
         THEN (sum(r) - count(*) * (count(*) + 1) / 2.0) / (count(*) * (max(n_all) - count(*))) END AS auc
  FROM rk GROUP BY Holdout, act)"""


def _eval(tail: str, **names) -> str:
    return with_views("predictions") + eval_ctes(**names) + "\n" + tail


def confusion_matrix() -> str:
    return _eval("SELECT Holdout, label, prediction, count(*) AS n FROM scored GROUP BY ALL")


def confusion_matrix_wide() -> str:
    names = ("Platinum", "Gold", "Silver", "Bronze", "Iron", "Other")
    counts = ", ".join(f"count(*) FILTER (WHERE predictionName = '{c}') AS {q(c)}" for c in names)
    return _eval(f"SELECT Holdout, labelName, {counts} FROM scored GROUP BY Holdout, labelName")


def auc_one_vs_one() -> str:
    """By counting: of all pairs of rows, one of either class, the share in
    which the class's own score ranks them right (ties count half)."""
    names = ("Iron", "Bronze", "Silver", "Gold")
    sides = [f"""
  SELECT x.Holdout, '{a}-{b}' AS pair,
    avg(CASE WHEN x.{q(own)} > y.{q(own)} THEN 1.0 WHEN x.{q(own)} = y.{q(own)} THEN 0.5 ELSE 0.0 END) AS auc
  FROM scored x JOIN scored y ON x.Holdout IS NOT DISTINCT FROM y.Holdout
   AND x.labelName = '{own}' AND y.labelName = '{b if own == a else a}'
   AND x.{q(a)} IS NOT NULL AND x.{q(b)} IS NOT NULL AND y.{q(a)} IS NOT NULL AND y.{q(b)} IS NOT NULL
  GROUP BY x.Holdout""" for i, a in enumerate(names) for b in names[i + 1:] for own in (a, b)]
    return _eval(f"""SELECT Holdout, round(avg(auc), 9) + 0.0 AS auc FROM (
  SELECT Holdout, pair, avg(auc) AS auc FROM ({' UNION ALL '.join(sides)}) s GROUP BY Holdout, pair) p GROUP BY Holdout""")


def named_class_metrics() -> str:
    return classification_metrics("VARCHAR", label="labelName", prediction="predictionName")


def classification_metrics(kind: str = "DOUBLE", **names) -> str:
    parts = [f"SELECT Holdout, '{m}' AS metric, class, round({c}, 9) + 0.0 AS value FROM st3"
             for m, c in (("precision", "prec"), ("recall", "rec"), ("f1", "f1"))]
    parts += [f"SELECT Holdout, '{m}' AS metric, CAST(NULL AS {kind}) AS class, round({m}, 9) + 0.0 AS value "
              f"FROM overall" for m in ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1")]
    return _eval("\nUNION ALL\n".join(parts), **names)


def auc_by_class() -> str:
    return _eval("SELECT Holdout, class, round(auc, 12) + 0.0 AS auc FROM auc")


def metric_table() -> str:
    return _eval("""SELECT o.Holdout, round(accuracy, 9) + 0.0 AS accuracy,
  round(weighted_precision, 9) + 0.0 AS weighted_precision, round(weighted_recall, 9) + 0.0 AS weighted_recall,
  round(weighted_f1, 9) + 0.0 AS weighted_f1,
  round((SELECT sum(auc * n_pos) / sum(n_pos) FROM auc WHERE auc.Holdout IS NOT DISTINCT FROM o.Holdout), 9) + 0.0 AS auc
FROM overall o""")


ORACLE.update({
    "confusion_matrix_wide": confusion_matrix_wide,
    "named_class_metrics": named_class_metrics,
    "auc_one_vs_one": auc_one_vs_one,
    "confusion_matrix": confusion_matrix,
    "classification_metrics": classification_metrics,
    "auc_by_class": auc_by_class,
    "metric_table": metric_table,
})


# ---------------------------------------------------------- files and sinks

def scan_union_partitions() -> str:
    return with_views("sales_raw") + f"\nSELECT * FROM sales_raw WHERE SALESORG IN ({lit(P.SALES_ORGS)})"


def scan_company_partitions() -> str:
    return with_views("coolers_raw") + f"\nSELECT * FROM coolers_raw WHERE COMP_CODE IN ({lit(P.COMPANY_CODES)})"


def csv_roundtrip() -> str:
    return with_views("customer_raw") + """
SELECT * REPLACE (TRY_CAST(LATITUDE AS DOUBLE) AS LATITUDE, TRY_CAST(LONGITUDE AS DOUBLE) AS LONGITUDE)
FROM customer_raw"""


# base-table columns that are not read back as double
TEXT_COLUMNS = ["CUSTOMER", "LONGITUDE", "LATITUDE", "CUST_CTRADE_CH", "CUST_CTRADE_CH_DESC", "TAA_TC", "CUST_CSUB_TRAD",
                "CUST_CSUB_TRAD_DESC", "CUST_GRP4", "CUST_GRP4_DESC", "CUST_CDMD_AREA", "CUST_CDMD_AREA_DESC", "CUST_ROUTED",
                "CUST_CCAF_GROUP", "POSTAL_CODE"]


def cast_columns(text: str = "{}") -> str:
    return ", ".join(f"{text.format(q(c))} AS {q(c)}" if c in TEXT_COLUMNS else f"TRY_CAST({q(c)} AS DOUBLE) AS {q(c)}"
                     for c in conf.ABT_COLUMNS)


def cast_model_inputs() -> str:
    return _abt_views() + "," + abt_ctes("", P.AS_OF) + f"\nSELECT {cast_columns()} FROM abt"


def load_latest_abt() -> str:
    """As read back from a file: all else is text."""
    return _abt_views() + "," + abt_ctes("", P.AS_OF) + f"\nSELECT {cast_columns('CAST({} AS VARCHAR)')} FROM abt"


def latest_file() -> str:
    return with_views("customer_raw") + """
SELECT CUSTOMER, SALESORG, CTRADE_CH_DESC, CDMD_AREA_DESC, ERDAT FROM customer_raw WHERE SALESORG = '1100'"""


def managed_table_roundtrip() -> str:
    return customer_master()


INGEST = """
SELECT *, (SELECT CAST(max(ts) AS DATE) FROM events WHERE event_type = 'purchase') AS DATA_UPDATED_DATE
FROM orders"""


def bulk_load() -> str:
    tables = {"customer": ("c_custkey", "c_name"), "orders": ("o_orderkey", "o_orderstatus"),
              "lineitem": ("l_orderkey", "l_returnflag"), "part": ("p_partkey", "p_name"),
              "supplier": ("s_suppkey", "s_name"), "nation": ("n_nationkey", "n_name"), "region": ("r_regionkey", "r_name")}
    return "\nUNION ALL\n".join(f"""
SELECT '{n}' AS object, (SELECT count(*) + 1 FROM (DESCRIBE {n})) AS columns, count(*) AS rows, CAST(sum({key}) AS BIGINT) AS key_total,
  CAST(sum(length({text})) AS BIGINT) AS text_length, count(DISTINCT {text}) AS texts,
  (SELECT CAST(max(ts) AS DATE) FROM events WHERE event_type = 'purchase') AS DATA_UPDATED_DATE
FROM {n}""" for n, (key, text) in tables.items())


ORACLE.update({
    "scan_union_partitions": scan_union_partitions,
    "scan_company_partitions": scan_company_partitions,
    "csv_roundtrip": csv_roundtrip,
    "cast_model_inputs": cast_model_inputs,
    "load_latest_abt": load_latest_abt,
    "latest_file": latest_file,
    "managed_table_roundtrip": managed_table_roundtrip,
    "ingest_stamp": lambda: INGEST,
    "ingest_write": lambda: INGEST,
    "bulk_load": bulk_load,
})


# --------------------------------------------------------------- modelling

def model_ctes() -> str:
    """Parts of the modelling table that don't depend on the forest: features
    kept (significant, and not too close to an earlier significant one),
    split, label index, customers that can be scored."""
    feats = _features()
    numeric = [f for f in feats if f not in TEXT_COLUMNS]
    order = ", ".join(f"('{f}', {i})" for i, f in enumerate(feats))
    texts = ", ".join(f"coalesce(CAST({q(f)} AS VARCHAR), '<NULL>') AS {q(f)}" for f in feats)
    return p_value_ctes() + f""",
cast_abt AS (SELECT {cast_columns('CAST({} AS VARCHAR)')} FROM abt),
important AS (SELECT feature FROM pv WHERE p < {conf.CHI_SQUARE_ALPHA}),
assoc AS ({_assoc_parts(feats, [c for c in feats if c in TEXT_COLUMNS]).replace("FROM abt", "FROM cast_abt")}),
close AS (
  SELECT feature_b AS feature FROM assoc
  WHERE feature_a IN (SELECT feature FROM important) AND feature_b IN (SELECT feature FROM important)
    AND NOT isnan(assoc) AND assoc > {conf.ASSOCIATION_THRESHOLD}),
ordered(feature, position) AS (VALUES {order}),
kept AS (SELECT feature FROM important WHERE feature NOT IN (SELECT feature FROM close)),
texts AS (SELECT CUSTOMER, {texts} FROM cast_abt),
cells AS (UNPIVOT texts
          ON {', '.join(q(f) for f in feats)} INTO NAME feature VALUE value),
incomplete AS (
  SELECT DISTINCT CUSTOMER FROM cells
  WHERE value = '<NULL>' AND feature IN (SELECT feature FROM kept) AND feature IN ({lit(numeric)})),
labelled AS (
  SELECT CUSTOMER, CUST_CCAF_GROUP AS labelCol,
    row_number() OVER (PARTITION BY CUST_CCAF_GROUP ORDER BY coalesce(md5(CUSTOMER), ''), coalesce(CUSTOMER, ''))
      <= floor({conf.TRAIN_FRACTION} * count(*) OVER (PARTITION BY CUST_CCAF_GROUP)) AS is_train
  FROM cast_abt WHERE CUST_CCAF_GROUP <> '{conf.LABEL_EXCLUDED}'),
label_index AS (
  SELECT labelCol, CAST(row_number() OVER (ORDER BY count(*) DESC, labelCol) - 1 AS DOUBLE) AS labelIndCol
  FROM labelled WHERE is_train GROUP BY labelCol),
scored_rows AS (
  SELECT l.CUSTOMER, l.labelCol, i.labelIndCol, CASE WHEN is_train THEN 'Train' ELSE 'Test' END AS Holdout
  FROM labelled l LEFT JOIN label_index i ON l.labelCol = i.labelCol
  WHERE l.labelCol <> '{conf.PREDICTION_EXCLUDED}' AND l.CUSTOMER NOT IN (SELECT CUSTOMER FROM incomplete))"""


def mbt_base() -> str:
    return model_ctes() + """
SELECT a.*, s.labelCol, s.labelIndCol, s.Holdout FROM cast_abt a LEFT JOIN scored_rows s ON a.CUSTOMER = s.CUSTOMER"""


def mbt_scores() -> str:
    return model_ctes() + """
SELECT Holdout, count(*) AS scored, count(*) AS valid, count(*) AS named FROM scored_rows GROUP BY Holdout"""


def model_roundtrip() -> str:
    return model_ctes() + "\nSELECT CUSTOMER, TRUE AS same FROM scored_rows"


def model_search(num_trees=conf.GRID_NUM_TREES, max_depth=conf.GRID_MAX_DEPTH, max_bins=conf.GRID_MAX_BINS, folds=conf.CV_FOLDS) -> str:
    """The grid, each set validated once on every train row that can be scored
    (rows of the class left out of the report included)."""
    grid = lambda name, values: f"(SELECT unnest([{', '.join(map(str, values))}]) AS {name})"
    return model_ctes() + f"""
SELECT CAST(num_trees AS INTEGER) AS num_trees, CAST(max_depth AS INTEGER) AS max_depth, CAST(max_bins AS INTEGER) AS max_bins,
  {folds} AS folds, (SELECT count(*) FROM labelled WHERE is_train AND CUSTOMER NOT IN (SELECT CUSTOMER FROM incomplete)) AS validated, TRUE AS valid
FROM {grid('num_trees', num_trees)}, {grid('max_depth', max_depth)}, {grid('max_bins', max_bins)}"""


def model_shape() -> str:
    """A number takes one place in the vector, a category one for each value
    seen in training and one for all others."""
    numeric = [f for f in _features() if f not in TEXT_COLUMNS]
    return model_ctes() + f""",
widths AS (
  SELECT k.feature, CASE WHEN k.feature IN ({lit(numeric)}) THEN 1 ELSE count(DISTINCT nullif(c.value, '<NULL>')) + 1 END AS w
  FROM kept k JOIN cells c ON c.feature = k.feature
  JOIN labelled l ON l.CUSTOMER = c.CUSTOMER AND l.is_train GROUP BY k.feature)
SELECT CAST((SELECT count(*) FROM label_index) AS INTEGER) AS classes, CAST((SELECT sum(w) FROM widths) AS INTEGER) AS width,
  CAST(1.0 AS DOUBLE) AS importance"""


ORACLE.update({
    "mbt_base": mbt_base,
    "mbt_scores": mbt_scores,
    "model_roundtrip": model_roundtrip,
    "model_search": model_search,
    "model_shape": model_shape,
})


# ------------------------------------------------------- rounding semantics

def spark_rounding(sql: str) -> str:
    """State Spark's ``round`` in DuckDB: HALF_UP on the shortest decimal
    form of the double (0.575 -> 0.58), where DuckDB's own ``round`` works
    on the binary value (0.57499... -> 0.57). Every ``round(x, d)`` in an
    oracle statement becomes a round of ``CAST(CAST(x AS VARCHAR) AS
    DECIMAL)``."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 0, j + 5, None
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
                if depth == 0:
                    break
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner = spark_rounding(sql[j + 6:comma])
        digits = sql[comma + 1:k].strip()
        out.append(sql[i:j])
        out.append(f"CAST(round(CAST(CAST(({inner}) AS VARCHAR) AS DECIMAL(38,17)), {digits}) AS DOUBLE)")
        i = k + 1
