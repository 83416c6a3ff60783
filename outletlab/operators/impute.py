"""Imputation operators.

* ``impute_nearest``      – missing demographic measures from the nearest
                            complete outlet within 5 km (grid equi-join).
* ``impute_hierarchical`` – own value, else mean of (channel, area), else
                            mean of channel, else overall mean.
* ``impute_zero``         – zero fill.
* unique-value currency   – see ``features.impute_unique_currency``.

All of them stay DataFrames end to end; group means are computed by one
map-side-combined aggregation at the finest level, the coarser levels are
derived from that small result, and the overall mean is a scalar subquery.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outletlab import conf
from outletlab.operators.spatial import nearest_within
from outletlab.plans.joins import null_safe_keys
from outletlab.session import cut_lineage


def completeness(cols) -> F.Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def nearest_donors(df: DataFrame, numeric_cols, *, key: str = "CUSTOMER", lat: str = "LATITUDE",
                   lon: str = "LONGITUDE", area: str = "_BIC_CDMD_AREA",
                   max_km: float = conf.NEAREST_MAX_KM, materialize: bool = True,
                   wanted: DataFrame | None = None) -> DataFrame:
    """(key, DONOR, distance_km) for incomplete rows with coordinates whose
    nearest complete row is closer than ``max_km``. Of all rows only those with
    a key in ``wanted`` are answered, if it is given; any row can give."""
    check = list(numeric_cols) + [lon, lat, area, key]
    base = df.select(key, lat, lon, completeness(check).alias("_complete"))
    if materialize:  # later steps read the narrow copy, not the upstream joins
        base = cut_lineage(base, "nearest_base")
    donors = base.filter("_complete").select(F.col(key).alias("DONOR"), lat, lon)
    queries = base.filter(~F.col("_complete")).select(key, lat, lon)
    if wanted is not None:
        queries = queries.join(wanted.select(key), key, "left_semi")
    return nearest_within(queries, donors, key=key, donor_key="DONOR", lat=lat, lon=lon,
                          max_km=max_km)


def impute_nearest(df: DataFrame, numeric_cols, *, key: str = "CUSTOMER", lat: str = "LATITUDE",
                   lon: str = "LONGITUDE", area: str = "_BIC_CDMD_AREA",
                   max_km: float = conf.NEAREST_MAX_KM,
                   area_fallback: bool = False, materialize: bool = True,
                   wanted: DataFrame | None = None) -> DataFrame:
    """Rows with any missing measure take each missing value from their
    nearest complete row within ``max_km``; other rows are unchanged.

    Only incomplete rows travel through the spatial join; the values of the
    donors that were chosen are attached to them by donor key, and the result
    is joined back to the input on ``key``. The area tells whether a row is
    complete but is never filled. With ``materialize`` the input is written
    once for the three reads. ``area_fallback=True`` additionally fills values
    still missing on rows that have coordinates but no donor within range with
    the mean of the known values in the same ``area``. With ``wanted`` only the
    rows whose key it has are returned; all rows can give values.
    """
    numeric_cols = list(numeric_cols)
    if materialize:
        df = cut_lineage(df, "imputation_input")
    match = nearest_donors(df, numeric_cols, key=key, lat=lat, lon=lon, area=area,
                           max_km=max_km, materialize=False, wanted=wanted)
    if materialize:
        match = cut_lineage(match, "nearest_donors")
    chosen = match.select("DONOR").distinct()
    donor_values = (df.withColumnRenamed(key, "DONOR").join(chosen, "DONOR", "left_semi")
                    .select("DONOR", *[F.col(c).alias(f"{c}__donor") for c in numeric_cols]))
    fills = match.join(donor_values, "DONOR").drop("distance_km")
    rows = df if wanted is None else df.join(wanted.select(key), key, "left_semi")
    out = rows.join(fills, key, "left")
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"{c}__donor")) for c in numeric_cols})
    if area_fallback:
        means = df.groupBy(area).agg(*[F.avg(c).alias(f"{c}__area") for c in numeric_cols])
        means, cond = null_safe_keys(out, means, [area])
        out = out.join(means, cond, "left").drop(f"{area}__r")
        beyond = F.col("DONOR").isNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull()
        out = out.withColumns({c: F.when(beyond, F.coalesce(F.col(c), F.col(f"{c}__area")))
                               .otherwise(F.col(c)) for c in numeric_cols})
        out = out.drop(*[f"{c}__area" for c in numeric_cols])
    return out.select(*df.columns)


def impute_hierarchical(df: DataFrame, columns: dict,
                        strata=("CUST_CTRADE_CH_DESC", "CUST_CDMD_AREA"),
                        materialize: bool = True, means_of: DataFrame | None = None) -> DataFrame:
    """``columns`` maps source column -> output column. Output = own value as
    double, else the mean over rows of the same (strata[0], strata[1]), else of
    the same strata[0], else of all rows. NULL strata form a group. The means
    are those of ``means_of``, if it is given, else of ``df``."""
    srcs = list(columns)
    strata = list(strata)
    v = {c: F.col(c).try_cast("double") for c in srcs}
    fine = (df if means_of is None else means_of).groupBy(*strata).agg(
        *[F.sum(v[c]).alias(f"s{i}") for i, c in enumerate(srcs)],
        *[F.count(v[c]).alias(f"n{i}") for i, c in enumerate(srcs)])
    if materialize:  # one row per stratum; later levels and the join reuse it
        fine = cut_lineage(fine, "strata_means")
    coarse = fine.groupBy(strata[0]).agg(
        *[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(srcs))],
        *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(srcs))])
    overall = fine.agg(F.struct(*[(F.sum(f"s{i}") / F.sum(f"n{i}")).alias(f"m{i}")
                                  for i in range(len(srcs))]).alias("m")).scalar()

    def means(frame, tag):
        return frame.select(*strata[: 2 if tag == "f" else 1],
                            *[(F.col(f"s{i}") / F.col(f"n{i}")).alias(f"{tag}{i}")
                              for i in range(len(srcs))])

    fine_m, cond_f = null_safe_keys(df, means(fine, "f"), strata)
    out = df.join(fine_m, cond_f, "left").drop(*[f"{k}__r" for k in strata])
    coarse_m, cond_c = null_safe_keys(out, means(coarse, "c"), strata[:1])
    out = out.join(coarse_m, cond_c, "left").drop(f"{strata[0]}__r")
    out = out.withColumns({
        columns[c]: F.coalesce(v[c], F.col(f"f{i}"), F.col(f"c{i}"), overall.getField(f"m{i}"))
        for i, c in enumerate(srcs)})
    return out.drop(*[f"f{i}" for i in range(len(srcs))], *[f"c{i}" for i in range(len(srcs))])


def impute_zero(df: DataFrame, cols) -> DataFrame:
    return df.fillna(0, subset=list(cols))
