"""Feature selection and sampling: contingency tables, chi-square tests,
association matrix with pruning, reproducible stratified split.

Everything is computed from aggregations over the whole table; no table is
brought to the driver. Values are compared as categories (their string
form, with NULL as a category of its own).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from outletlab import conf
from outletlab.functions.stats import chi2_sf
from outletlab.operators.gram import cross_products
from outletlab.plans.joins import broadcast_counted, null_safe_keys
from outletlab.session import cut_lineage

NULL_CATEGORY = "<NULL>"
SPREAD = 1e-12  # least share of a sum of squares that is a spread and not rounding
NUMERIC_TYPES = ("double", "float", "int", "bigint", "smallint", "tinyint")


def as_category(c) -> F.Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string"), F.lit(NULL_CATEGORY))


# --------------------------------------------------------------- contingency

def contingency(df: DataFrame, features, label: str) -> DataFrame:
    """(feature, value, label, n) for all features in one pass: the table is
    unpivoted once and counted with a map-side-combined group-by."""
    features = list(features)
    wide = df.select(as_category(label).alias("label"),
                     *[as_category(f).alias(f"f{i}") for i, f in enumerate(features)])
    long = wide.unpivot("label", [f"f{i}" for i in range(len(features))], "fid", "value")
    names = F.element_at(F.array(*[F.lit(f) for f in features]),
                         F.substring("fid", 2, 10).cast("int") + 1)
    return (long.groupBy("fid", "value", "label").agg(F.count(F.lit(1)).alias("n"))
            .select(names.alias("feature"), "value", "label", "n"))


# ----------------------------------------------------------------- chi-square

def chi_square(df: DataFrame, features, label: str, alpha: float = conf.CHI_SQUARE_ALPHA,
               materialize: bool = True) -> DataFrame:
    """Chi-square test of independence of every feature against ``label``.

    Returns (feature, chi2, dof, p_value, important). Expected counts are
    R_i * C_j / N. Cells never observed contribute their expected count, so
    the statistic is sum_obs (O - E)^2 / E + (N - sum_obs E). With one degree
    of freedom Yates' continuity correction is applied (|O - E| reduced by
    at most 0.5), for which the four cells of the 2x2 table are enumerated.
    """
    cont = contingency(df, features, label)
    if materialize:  # features x values x labels rows, read by every step below
        cont = cut_lineage(cont, "contingency")
    # features x labels rows: counted, then broadcast, so that the cells (which
    # grow with the values of continuous features) are not dealt by feature
    row_m = broadcast_counted(cont.groupBy("feature", "label").agg(F.sum("n").alias("R")), "label_margins")
    totals = broadcast_counted(row_m.groupBy("feature").agg(F.sum("R").alias("total"), F.count(F.lit(1)).alias("n_labels")), "feature_totals")
    col_w = Window.partitionBy("feature", "value")
    cells = (cont.withColumn("C", F.sum("n").over(col_w)).withColumn("first_of_value", F.row_number().over(col_w.orderBy("label")) == 1)
             .join(row_m, ["feature", "label"]).join(totals, "feature"))
    e = F.col("R").cast("double") * F.col("C") / F.col("total")
    cells = cells.withColumn("E", e)
    plain = cells.groupBy("feature").agg(
        F.sum((F.col("n") - F.col("E")) * (F.col("n") - F.col("E")) / F.col("E")).alias("obs_part"),
        F.sum("E").alias("obs_e"),
        F.sum(F.col("first_of_value").cast("long")).alias("n_values"),
        F.first("total").alias("total"), F.first("n_labels").alias("n_labels"))
    plain = plain.withColumns({
        "chi2_plain": F.col("obs_part") + (F.col("total") - F.col("obs_e")),
        "dof": (F.col("n_labels") - 1) * (F.col("n_values") - 1),
    })
    plain = cut_lineage(plain, "plain_statistics")  # one row a feature
    # Yates: features with a 2x2 table, all four cells (unobserved ones with O = 0).
    two = plain.filter("dof = 1").select("feature", "total")
    small = cont.join(F.broadcast(two), "feature")  # four cells a feature at most
    grid = (small.groupBy("feature", "value", "total").agg(F.sum("n").alias("C"))
            .join(row_m, "feature").join(small.select("feature", "value", "label", "n"), ["feature", "value", "label"], "left"))
    dev = F.abs(F.coalesce(F.col("n"), F.lit(0)) - F.col("R").cast("double") * F.col("C") / F.col("total"))
    ex = F.col("R").cast("double") * F.col("C") / F.col("total")
    yates = grid.groupBy("feature").agg(
        F.sum((dev - F.least(F.lit(0.5), dev)) * (dev - F.least(F.lit(0.5), dev)) / ex).alias("chi2_yates"))
    out = plain.join(yates, "feature", "left").select(
        "feature",
        F.when(F.col("dof") == 1, F.col("chi2_yates")).otherwise(F.col("chi2_plain")).alias("chi2"),
        F.col("dof").cast("bigint").alias("dof"))
    out = out.withColumn("p_value", chi2_sf(F.col("chi2"), F.col("dof").cast("double")))
    return out.withColumn("important", F.col("p_value") < F.lit(alpha))


# --------------------------------------------------------------- associations

def _kinds(df: DataFrame, features):
    types = dict(df.dtypes)
    numeric = [f for f in features if types[f] in NUMERIC_TYPES or types[f].startswith("decimal")]
    return numeric, [f for f in features if f not in numeric]


def associations(df: DataFrame, features, materialize: bool = True) -> DataFrame:
    """Association of every ordered feature pair (a before b in ``features``):
    Pearson correlation for two numeric features, Cramér's V for two
    categorical ones, correlation ratio (eta) for a categorical and a numeric
    one. Pairwise-complete rows only. Returns (feature_a, feature_b, kind,
    assoc), read off the cross products of all pairs (``operators/gram.py``),
    which one pass over the table sums around the columns' means. With
    ``materialize`` the feature columns and the cross products are written once.
    """
    features = list(features)
    if materialize:
        df = cut_lineage(df.select(*features), "association_input")
    numeric, categorical = _kinds(df, features)
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1:]]
    kinds = ["pearson" if a in numeric and b in numeric else "cramers_v" if a in categorical and b in categorical else "eta" for a, b in pairs]
    centres = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in numeric]).first().asDict() if numeric else {}
    cells = cross_products(df, numeric, categorical, pairs, {c: m for c, m in centres.items() if m is not None and math.isfinite(m)})
    if materialize:
        cells = cut_lineage(cells, "cross_products")
    spark = df.sparkSession
    named = F.broadcast(spark.createDataFrame([(i, *p, k) for i, (p, k) in enumerate(zip(pairs, kinds, strict=True))],
                                              "pair int, feature_a string, feature_b string, kind string"))
    # spreads that are only what rounding left of equal values count as none
    spread = lambda square, total, n: F.when(square - total * total / n > SPREAD * square, square - total * total / n)
    sums = named.filter("kind = 'pearson'").join(cells.filter("n > 0"), "pair", "left")  # a pair without a complete row has no value
    a, b = spread(F.col("aa"), F.col("a"), F.col("n")), spread(F.col("bb"), F.col("b"), F.col("n"))
    pearson = sums.withColumn("assoc", F.nanvl((F.col("ab") - F.col("a") * F.col("b") / F.col("n")) / F.sqrt(a * b), F.lit(None).cast("double")))
    mixed = cells.join(named.filter("kind = 'eta'"), "pair").groupBy("pair", "feature_a", "feature_b", "kind").agg(
        F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("aa").alias("aa"), F.sum(F.col("a") * F.col("a") / F.col("n")).alias("groups"))
    total = spread(F.col("aa"), F.col("a"), F.col("n"))
    between = F.greatest(F.col("groups") - F.col("a") * F.col("a") / F.col("n"), F.lit(0.0))
    eta = mixed.withColumn("assoc", F.when(total > 0, F.sqrt(F.least(between / total, F.lit(1.0)))))

    counts = cells.join(named.filter("kind = 'cramers_v'"), "pair").select("pair", "va", "vb", "n")
    # margins as aggregates joined back (no window over a value's or a
    # pair's rows, which a high-cardinality feature would make unbounded)
    ma = counts.groupBy("pair", "va").agg(F.sum("n").alias("A"))
    mb = counts.groupBy("pair", "vb").agg(F.sum("n").alias("B"))
    totals = broadcast_counted(ma.groupBy("pair").agg(F.sum("A").alias("T"), F.count(F.lit(1)).alias("ra")), "pair_totals")  # one row a pair
    widths = broadcast_counted(mb.groupBy("pair").agg(F.count(F.lit(1)).alias("rb")), "pair_widths")
    # sum (n - e)^2 / e over all cells, with e = A B / T, is T (sum n^2 / (A B) - 1)
    chi = counts.join(ma, ["pair", "va"]).join(mb, ["pair", "vb"]).groupBy("pair").agg(
        F.sum(F.col("n").cast("double") * F.col("n") / (F.col("A").cast("double") * F.col("B"))).alias("q"))
    k = F.least("ra", "rb") - 1
    cramer = chi.join(totals, "pair").join(widths, "pair").join(named, "pair").withColumn("assoc", F.when(k > 0, F.sqrt(F.greatest(F.col("q") - 1, F.lit(0.0)) / k)))
    out = ["feature_a", "feature_b", "kind", "assoc"]
    return pearson.select(*out).unionByName(eta.select(*out)).unionByName(cramer.select(*out))


def association_prune(assoc: DataFrame, features, threshold: float = conf.ASSOCIATION_THRESHOLD,
                      absolute: bool = False) -> DataFrame:
    """(feature, max_prior_assoc, dropped): a feature is dropped when its
    association with any earlier feature exceeds ``threshold`` (signed by
    default, as in the original; ``absolute=True`` compares |assoc|)."""
    value = F.abs("assoc") if absolute else F.col("assoc")
    worst = assoc.groupBy(F.col("feature_b").alias("feature")).agg(F.max(value).alias("max_prior_assoc"))
    spark = assoc.sparkSession
    order = spark.createDataFrame([(f, i) for i, f in enumerate(features)], "feature string, position int")
    return (order.join(worst, "feature", "left")
            .select("feature", "position", "max_prior_assoc",
                    F.coalesce(F.col("max_prior_assoc") > threshold, F.lit(False)).alias("dropped")))


# ----------------------------------------------------------- stratified split

def split_labels(df: DataFrame, label: str, key: str, frac: float = conf.TRAIN_FRACTION,
                 bucket_hex: int = 5) -> DataFrame:
    """Add ``split`` = 'train' / 'test': per label the floor(frac * n) rows
    with the smallest (md5(key), key) are train. Reproducible whatever the
    partitioning. A NULL key sorts first; equal keys go to the same part.

    No window runs over a whole label: rows are counted per (label, hash
    bucket), a running count over that table (at most 16^bucket_hex rows a
    label) names the bucket in which the label's cut lies, only the rows of
    that bucket are ranked, and every row is compared with its label's cut.
    """
    tag = {"_h": F.coalesce(F.md5(F.col(key).cast("string").cast("binary")), F.lit("")), "_key": F.coalesce(F.col(key).cast("string"), F.lit(""))}
    rows = df.withColumns(tag).withColumn("_b", F.coalesce(F.conv(F.substring("_h", 1, bucket_hex), 16, 10).cast("bigint"), F.lit(-1)))
    buckets = rows.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(label).orderBy("_b")
    buckets = buckets.withColumns({
        "_before": F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_k": F.floor(F.lit(frac) * F.sum("_cnt").over(Window.partitionBy(label))),
    })
    edge = broadcast_counted(buckets.filter("_before < _k AND _k <= _before + _cnt").drop("_cnt"), "split_buckets")  # one a label
    edge, cond = null_safe_keys(rows, edge, [label, "_b"])
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_h", "_key"))
    cuts = (rows.join(edge, cond).withColumn("_rank", rank).filter("_before + _rank = _k")
            .select(label, F.struct("_h", "_key").alias("_cut")))
    cuts, cond = null_safe_keys(rows, broadcast_counted(cuts, "split_cuts"), [label])
    is_train = F.struct("_h", "_key") <= F.col("_cut")
    split = F.when(is_train, F.lit("train")).otherwise(F.lit("test"))
    return rows.join(cuts, cond, "left").withColumn("split", split).select(*[rows[c] for c in df.columns], "split")


def stratified_split_train_test(df: DataFrame, frac: float, label: str, join_on: str):
    """(train, test) from one run of the split, so no row is in both."""
    tagged = cut_lineage(split_labels(df, label, join_on, frac), "split")
    return tuple(tagged.filter(F.col("split") == part).drop("split") for part in ("train", "test"))
