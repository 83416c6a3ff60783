"""Analytical base table (one row per customer) and its incremental append."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outletlab import conf
from outletlab.operators import features as fe
from outletlab.operators.impute import impute_hierarchical, impute_nearest, impute_zero
from outletlab.session import cut_lineage

STRATA = ("CUST_CTRADE_CH_DESC", "CUST_CDMD_AREA")
SALES_IMPUTED = {
    fe.SALES_VOLUME_MEAN: "Sales_Volume_in_UC_imputed",
    fe.SALES_NSR_MEAN: "Sales_NSR_imputed",
}


def analytical_base_table(customers: DataFrame, demographics: DataFrame, coolers: DataFrame,
                          sales: DataFrame, columns=None, *, area_fallback: bool = False,
                          materialize: bool = True, wanted: DataFrame | None = None) -> DataFrame:
    """Star join, nearest-outlet imputation of demographics, hierarchical
    means for sales, zero fill, column selection.

    The nearest-outlet step only reads and writes demographic columns, so it
    runs on customer ⟕ demographics before coolers and sales are joined (same
    result, narrower rows through the spatial join). With ``materialize`` the
    joined table is written once to the shared checkpoint folder before the
    group means, which then read it instead of re-running the sources.

    With ``wanted`` (CUSTOMER) only these customers' rows are built: all
    customers give values and count in the group means, for which only strata
    and sales are joined.
    """
    demo = demographics.drop("LONGITUDE", "LATITUDE")
    numeric = fe.demographic_numeric_columns(demo)
    with_demo = customers.join(demo, "CUSTOMER", "left")
    with_demo = impute_nearest(with_demo, numeric, area_fallback=area_fallback, materialize=materialize, wanted=wanted)
    abt = with_demo.join(coolers, "CUSTOMER", "left").join(sales, "CUSTOMER", "left")
    if materialize:
        abt = cut_lineage(abt, "abt_joined")
    every = None if wanted is None else customers.select("CUSTOMER", *STRATA).join(sales, "CUSTOMER", "left")
    abt = impute_hierarchical(abt, SALES_IMPUTED, STRATA, materialize=materialize, means_of=every)
    abt = impute_zero(abt, list(SALES_IMPUTED.values()))
    return abt.select(*(columns or conf.ABT_COLUMNS))


def new_rows(current: DataFrame, previous: DataFrame, key: str = "CUSTOMER") -> DataFrame:
    """Rows of ``current`` whose key is absent from ``previous``."""
    return current.join(previous.select(key), key, "left_anti")


def _with_pardt(previous: DataFrame, types: dict, default_pardt: str) -> DataFrame:
    """Rows of an earlier snapshot as ``types`` say, with their own ``pardt``."""
    if "pardt" not in previous.columns:
        previous = previous.withColumn("pardt", F.lit(default_pardt))
    return previous.select(
        *[(F.col(c).try_cast(t) if c in previous.columns else F.lit(None).cast(t)).alias(c) for c, t in types.items()],
        F.col("pardt").cast("string").alias("pardt"))


def incremental_base_table(current: DataFrame, previous: DataFrame, pardt: str,
                           default_previous_pardt: str = conf.DEFAULT_PREVIOUS_PARDT,
                           key: str = "CUSTOMER") -> DataFrame:
    """Previous snapshot plus the customers it does not have yet.

    Previous rows keep their own ``pardt`` (``default_previous_pardt`` when
    the snapshot has none); new rows get ``pardt``. Columns are matched by
    name and previous values are cast to the current types. ``current`` may
    have all customers or the new ones only.
    """
    prev = _with_pardt(previous, dict(current.dtypes), default_previous_pardt)
    fresh = new_rows(current, prev, key).withColumn("pardt", F.lit(pardt))
    return prev.unionByName(fresh)


def base_table_path(output_root: str, country: str, partition_date: str) -> str:
    return f"{output_root.rstrip('/')}/{country.upper()}/output/{country}_abt_{partition_date}.csv"


def _newest(spark, output_root: str) -> DataFrame | None:
    from outletlab.sources import files as fs

    try:
        return fs.load_latest_csv(spark, output_root)
    except FileNotFoundError:
        return None


def store_snapshot(spark, current: DataFrame, output_root: str, country: str, run_date: str,
                   partition_date: str | None = None, previous: DataFrame | None = None) -> str:
    """Append the customers the newest stored snapshot (``previous``, if the
    caller has loaded it) does not have to it, all rows when there is none, and
    write the result as a new CSV snapshot. Returns its path, which ends in
    ``partition_date`` or else in the run date and the time of day."""
    from outletlab.sources import files as fs

    previous = previous if previous is not None else _newest(spark, output_root)
    result = current.withColumn("pardt", F.lit(run_date)) if previous is None else incremental_base_table(current, previous, run_date)
    path = base_table_path(output_root, country, partition_date or f"{run_date}_{datetime.now():%H%M%S}")
    fs.write_csv(result, path)
    return path


def build_and_store_base_table(spark, customers: DataFrame, demographics: DataFrame,
                               coolers: DataFrame, sales: DataFrame, output_root: str, country: str,
                               run_date: str, partition_date: str | None = None,
                               columns=None, finish=None) -> str:
    """Entry point of the base-table run: build the rows of the customers that
    the newest snapshot doesn't have (of all when there is none) and store them
    with it. ``finish`` is applied to the rows built."""
    previous, wanted = _newest(spark, output_root), None
    if previous is not None:
        wanted = cut_lineage(new_rows(customers.select("CUSTOMER"), previous), "new_customers")
    current = analytical_base_table(customers, demographics, coolers, sales, columns, wanted=wanted)
    return store_snapshot(spark, finish(current) if finish else current, output_root, country, run_date, partition_date, previous)
