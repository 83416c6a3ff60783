"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
computed over the whole fixture tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outletlab import conf
from outletlab.checks import params as P
from outletlab.operators import features as fe
from outletlab.operators import impute as im
from outletlab.operators import metrics as me
from outletlab.operators import select as sel
from outletlab.plans import base_table as bt
from outletlab.plans import ingestion as ing
from outletlab.plans import model as mo
from outletlab.session import cut_lineage, scratch_path
from outletlab.sources import country as cy
from outletlab.sources import files as fs
from outletlab.sources.fixtures import WRITE_OPERATION, table, view


def _sales_lines(spark, sf):
    return fe.sales_lines(view(spark, sf, "sales_raw"), view(spark, sf, "calendar"), P.SALES_ORGS)


def customer_master(spark: SparkSession, sf: str) -> DataFrame:
    return fe.customer_features(view(spark, sf, "customer_raw"), P.SALES_ORGS, P.ACCOUNT_GROUPS, P.AS_OF)


def cooler_features(spark: SparkSession, sf: str) -> DataFrame:
    return fe.cooler_features(view(spark, sf, "coolers_raw"), company_codes=P.COMPANY_CODES)


def demographic_features(spark: SparkSession, sf: str) -> DataFrame:
    return fe.demographic_features(view(spark, sf, "demographics_raw"))


def latest_fiscal_period(spark: SparkSession, sf: str) -> DataFrame:
    latest = fe.latest_fiscal_period(_sales_lines(spark, sf))
    start, _ = fe.period_window(F.col("FISCPER"))  # noqa: F841
    return latest.select(F.col("FISCPER").alias("FISCPER_LATEST"),
                         start.cast("string").alias("FISCPER_START"))


def sales_lines(spark: SparkSession, sf: str) -> DataFrame:
    return fe.sales_amounts(fe.sales_in_window(_sales_lines(spark, sf)))


def currency_impute(spark: SparkSession, sf: str) -> DataFrame:
    return fe.impute_unique_currency(sales_lines(spark, sf))


def sales_features(spark: SparkSession, sf: str) -> DataFrame:
    return fe.sales_pipeline(view(spark, sf, "sales_raw"), view(spark, sf, "calendar"), P.SALES_ORGS)


def sales_features_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return fe.sales_pipeline(view(spark, sf, "sales_raw"), view(spark, sf, "calendar"), P.SALES_ORGS,
                             weighting="month")


QUERIES = {
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


MEAN_DIGITS = 6  # float means summed in unspecified order are reported to 1e-6


def _customers(spark, sf, as_of=P.AS_OF):
    return fe.customer_features(view(spark, sf, "customer_raw"), P.SALES_ORGS, P.ACCOUNT_GROUPS, as_of)


def _demographics(spark, sf):
    return fe.demographic_features(view(spark, sf, "demographics_raw"))


def _star(spark, sf):
    demo = _demographics(spark, sf).drop("LONGITUDE", "LATITUDE")
    star = _customers(spark, sf).join(demo, "CUSTOMER", "left")
    return star, fe.demographic_numeric_columns(demo)


def round_means(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.round(c, MEAN_DIGITS) for c in cols})


def nearest_outlet(spark: SparkSession, sf: str) -> DataFrame:
    star, numeric = _star(spark, sf)
    return im.nearest_donors(star, numeric)


def impute_nearest(spark: SparkSession, sf: str) -> DataFrame:
    star, numeric = _star(spark, sf)
    return im.impute_nearest(star, numeric)


def impute_area_mean(spark: SparkSession, sf: str) -> DataFrame:
    star, numeric = _star(spark, sf)
    return round_means(im.impute_nearest(star, numeric, area_fallback=True), numeric)


def impute_hierarchical(spark: SparkSession, sf: str) -> DataFrame:
    cust = _customers(spark, sf).select("CUSTOMER", "CUST_CTRADE_CH_DESC", "CUST_CDMD_AREA")
    df = cust.join(sales_features(spark, sf), "CUSTOMER", "left")
    out = im.impute_zero(im.impute_hierarchical(df, bt.SALES_IMPUTED), list(bt.SALES_IMPUTED.values()))
    return round_means(out, bt.SALES_IMPUTED.values())


def _sources(spark, sf):
    return _demographics(spark, sf), cooler_features(spark, sf), sales_features(spark, sf)


def _abt(spark, sf, as_of=P.AS_OF, sources=None):
    demographics, coolers, sales = sources or _sources(spark, sf)
    abt = bt.analytical_base_table(_customers(spark, sf, as_of), demographics, coolers, sales)
    return round_means(abt, bt.SALES_IMPUTED.values())


def abt(spark: SparkSession, sf: str) -> DataFrame:
    return _abt(spark, sf)


def abt_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs: the earlier one stores its CSV snapshot, the later one reads
    the newest snapshot back, builds and appends the new customers and stores
    its own, whose rows are returned (typed as the base table). Both runs join
    the sources stored by customer."""
    tag = uuid.uuid4().hex[:8]
    sources = tuple(fs.save_bucketed(s, f"outletlab_{n}_{tag}", scratch_path(spark, n), "CUSTOMER")
                    for n, s in zip(("demographics", "coolers", "sales"), _sources(spark, sf), strict=True))
    root = scratch_path(spark, "abt_snapshots")
    types: dict = {}

    def rounded(rows: DataFrame) -> DataFrame:
        rows = round_means(rows, bt.SALES_IMPUTED.values())
        types.update(rows.dtypes)
        return rows

    for as_of, pardt in ((P.PREVIOUS_AS_OF, P.PREVIOUS_PARDT), (P.AS_OF, P.RUN_PARDT)):
        bt.build_and_store_base_table(spark, _customers(spark, sf, as_of), *sources, root, P.COUNTRY, pardt, f"{pardt}_000000", finish=rounded)
    stored = fs.load_latest_csv(spark, root)
    return stored.select(*[F.col(c).try_cast(t).alias(c) for c, t in types.items()], "pardt")


QUERIES.update({
    "nearest_outlet": nearest_outlet,
    "impute_nearest": impute_nearest,
    "impute_area_mean": impute_area_mean,
    "impute_hierarchical": impute_hierarchical,
    "abt": abt,
    "abt_incremental": abt_incremental,
})


# ------------------------------------------------------ feature selection


LABEL = "CUST_CCAF_GROUP"
ROUND = 6


def selection_features(columns=None) -> list:
    """Base-table columns tested against the label (exclusions from the
    modelling configuration; the label itself is not a feature)."""
    excluded = set(conf.FEATURE_SELECTION_EXCLUDED) | {LABEL}
    return [c for c in (columns or conf.ABT_COLUMNS) if c not in excluded]


def chi_square(spark: SparkSession, sf: str) -> DataFrame:
    out = sel.chi_square(_abt(spark, sf), selection_features(), LABEL)
    return out.select("feature", F.round("chi2", ROUND).alias("chi2"), "dof")


def chi_square_selection(spark: SparkSession, sf: str) -> DataFrame:
    out = sel.chi_square(_abt(spark, sf), selection_features(), LABEL)
    return out.select("feature", F.round("chi2", ROUND).alias("chi2"), "dof",
                      F.round("p_value", ROUND).alias("p_value"), "important")


def association_matrix(spark: SparkSession, sf: str) -> DataFrame:
    out = sel.associations(_abt(spark, sf), selection_features())
    return out.withColumn("assoc", F.round("assoc", ROUND))


def association_prune(spark: SparkSession, sf: str) -> DataFrame:
    feats = selection_features()
    assoc = sel.associations(_abt(spark, sf), feats).withColumn("assoc", F.round("assoc", ROUND))
    return sel.association_prune(assoc, feats)


def _labelled_customers(spark, sf):
    cust = _customers(spark, sf).filter(F.col(LABEL) != conf.LABEL_EXCLUDED)
    return cust.select("CUSTOMER", F.col(LABEL).alias("targetVar"))


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return sel.split_labels(_labelled_customers(spark, sf), "targetVar", "CUSTOMER")


QUERIES.update({
    "chi_square": chi_square,
    "chi_square_selection": chi_square_selection,
    "association_matrix": association_matrix,
    "association_prune": association_prune,
    "stratified_split": stratified_split,
})


# ------------------------------------------------------------- evaluation


METRIC_DIGITS = 9


def _predictions(spark, sf):
    """Scored customers with a modelled label (the 'Other' class is left
    out, as before modelling)."""
    return view(spark, sf, "predictions").filter(F.col("labelName") != conf.LABEL_EXCLUDED)


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return me.confusion_matrix(_predictions(spark, sf), by="Holdout")


def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    out = me.classification_metrics(_predictions(spark, sf), by="Holdout")
    return out.withColumn("value", F.round("value", METRIC_DIGITS))


def auc_by_class(spark: SparkSession, sf: str) -> DataFrame:
    out = me.auc_one_vs_rest(_predictions(spark, sf), by="Holdout")
    return out.withColumn("auc", F.round("auc", 12))


def metric_table(spark: SparkSession, sf: str) -> DataFrame:
    out = me.metric_table(_predictions(spark, sf))
    return out.withColumns({c: F.round(c, METRIC_DIGITS) for c in out.columns if c != "Holdout"})


CLASS_NAMES = ["Platinum", "Gold", "Silver", "Bronze", "Iron", "Other"]
SCORED_CLASSES = ["Iron", "Bronze", "Silver", "Gold"]


def confusion_matrix_wide(spark: SparkSession, sf: str) -> DataFrame:
    return me.confusion_matrix_wide(_predictions(spark, sf), "labelName", "predictionName", by="Holdout", classes=CLASS_NAMES)


def named_class_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The metrics of classes called by name."""
    out = me.classification_metrics(_predictions(spark, sf), "labelName", "predictionName", by="Holdout")
    return out.withColumn("value", F.round("value", METRIC_DIGITS))


def auc_one_vs_one(spark: SparkSession, sf: str) -> DataFrame:
    out = me.auc_one_vs_one(_predictions(spark, sf), "labelName", {c: c for c in SCORED_CLASSES}, by="Holdout")
    return out.withColumn("auc", F.round("auc", METRIC_DIGITS))


QUERIES.update({
    "confusion_matrix_wide": confusion_matrix_wide,
    "named_class_metrics": named_class_metrics,
    "auc_one_vs_one": auc_one_vs_one,
    "confusion_matrix": confusion_matrix,
    "classification_metrics": classification_metrics,
    "auc_by_class": auc_by_class,
    "metric_table": metric_table,
})


# ---------------------------------------------------------- files and sinks




def scan_union_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Sales lines stored one directory per sales organisation, read for the
    organisations of one country (join with the country dimension ->
    dynamic partition pruning)."""
    raw = view(spark, sf, "sales_raw")
    root = fs.write_parquet(raw, scratch_path(spark, "sales_by_org"), partition_by="SALESORG")
    orgs = cy.sales_orgs(cy.country_dimension(spark), P.COUNTRY)
    return fs.read_partitioned_by_dimension(spark, root, "SALESORG", orgs, schema=raw.schema)


def scan_company_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Cooler lines stored one directory per company code ('0480'), read for a
    static code list (static partition pruning; codes stay strings)."""
    raw = view(spark, sf, "coolers_raw")
    root = fs.write_parquet(raw, scratch_path(spark, "coolers_by_code"), partition_by="COMP_CODE")
    return fs.read_partitioned(spark, root, "COMP_CODE", P.COMPANY_CODES, schema=raw.schema)


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Customer master written as pipe-separated CSV with header and read
    back with an explicit all-string schema; coordinates typed on read."""
    raw = view(spark, sf, "customer_raw")
    path = fs.write_csv(raw, scratch_path(spark, "customer_csv"), sep="|")
    back = fs.read_csv(spark, path, fs.string_schema(raw.columns), sep="|")
    return back.withColumns({c: F.col(c).try_cast("double") for c in ("LATITUDE", "LONGITUDE")})


def cast_model_inputs(spark: SparkSession, sf: str) -> DataFrame:
    return mo.cast_to_double(_abt(spark, sf), conf.MODEL_DOUBLE_COLUMNS)


def load_latest_abt(spark: SparkSession, sf: str) -> DataFrame:
    """Base table written as CSV under a country output folder; the newest
    file there names the data set to load, read back by its header and typed
    for modelling."""
    root = scratch_path(spark, "abt_out")
    fs.write_csv(_abt(spark, sf), f"{root}/{P.COUNTRY.upper()}/output/{P.COUNTRY}_abt_{P.RUN_PARDT}_000000.csv")
    return mo.load_base_table(spark, root)


def latest_file(spark: SparkSession, sf: str) -> DataFrame:
    """The customers of every company stored one after the other; the newest
    file names the set that is read back: the last one, with its columns in
    another order."""
    raw = view(spark, sf, "customer_raw")
    root = scratch_path(spark, "customer_snapshots")
    for org in ("7800", "7900", "1100"):
        part = raw.filter(F.col("SALESORG") == org)
        fs.write_csv(part.select(*sorted(raw.columns, reverse=org == "1100")), f"{root}/{org}/customers.csv")
    return fs.load_latest_csv(spark, root).select("CUSTOMER", "SALESORG", "CTRADE_CH_DESC", "CDMD_AREA_DESC", "ERDAT")


def managed_table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    name = f"outletlab_customer_master_{uuid.uuid4().hex[:8]}"
    return fs.save_table(customer_master(spark, sf), name, scratch_path(spark, name))


def ingest_stamp(spark: SparkSession, sf: str) -> DataFrame:
    return ing.load_stamped(table(spark, sf, "orders"), view(spark, sf, "commit_log"), WRITE_OPERATION)


def ingest_write(spark: SparkSession, sf: str) -> DataFrame:
    """The stamped orders as a table registered in the first layer's database."""
    root = ing.layer_path(scratch_path(spark, "layers"), "org", "prod", "L1", P.COUNTRY)
    database = ing.layer_database_name(P.COUNTRY, "outletlab", "core", "l1")
    return ing.write_layer(ingest_stamp(spark, sf), root, database, f"orders_{uuid.uuid4().hex[:8]}")


# object -> a numeric and a text column, whose contents are reported
BULK_OBJECTS = {"customer": ("c_custkey", "c_name"), "orders": ("o_orderkey", "o_orderstatus"),
                "lineitem": ("l_orderkey", "l_returnflag"), "part": ("p_partkey", "p_name"),
                "supplier": ("s_suppkey", "s_name"), "nation": ("n_nationkey", "n_name"), "region": ("r_regionkey", "r_name")}


def bulk_load(spark: SparkSession, sf: str) -> DataFrame:
    """The full load (clean names, stamp) of a list of objects, and of each
    its rows, stamp and column contents."""
    loaded = ing.bulk_load(lambda n: table(spark, sf, n), BULK_OBJECTS, view(spark, sf, "commit_log"), WRITE_OPERATION)
    reports = [df.agg(F.count(F.lit(1)).alias("rows"), F.sum(BULK_OBJECTS[n][0]).cast("long").alias("key_total"),
                      F.sum(F.length(BULK_OBJECTS[n][1])).cast("long").alias("text_length"),
                      F.count_distinct(BULK_OBJECTS[n][1]).alias("texts"),
                      F.max(ing.UPDATED_DATE_COLUMN).alias(ing.UPDATED_DATE_COLUMN))
               .select(F.lit(n).alias("object"), F.lit(len(df.columns)).alias("columns"), "*")
               for n, df in loaded.items()]
    return reduce(DataFrame.unionByName, reports)


QUERIES.update({
    "scan_union_partitions": scan_union_partitions,
    "scan_company_partitions": scan_company_partitions,
    "csv_roundtrip": csv_roundtrip,
    "cast_model_inputs": cast_model_inputs,
    "load_latest_abt": load_latest_abt,
    "latest_file": latest_file,
    "managed_table_roundtrip": managed_table_roundtrip,
    "ingest_stamp": ingest_stamp,
    "ingest_write": ingest_write,
    "bulk_load": bulk_load,
})


# -------------------------------------------------------------- modelling



MODEL_CONFIG = mo.ModelConfig()  # the whole search
_models: dict = {}  # by application and tables: where the fitted model and its tables are


def _modelled(spark, sf):
    """(base table, predictions, loaded model, kept features, data modelled,
    search scores): fitted on the newest stored base table and saved by the
    first query that asks, read back by all."""
    key = (spark.sparkContext.applicationId, sf, repr(MODEL_CONFIG))
    if key not in _models:
        root = scratch_path(spark, "mbt")
        abt = cut_lineage(load_latest_abt(spark, sf), "model_abt")
        kept = mo.select_features(abt, selection_features())
        mbt, preds, model, scores = mo.model_base_table(abt, kept, cfg=MODEL_CONFIG)
        mo.save_model(model, mbt, f"{root}/artifacts", f"{root}/data")
        _models[key] = (f"{root}/artifacts", f"{root}/data", preds, kept, abt, scores)
    artifacts, data, *rest = _models[key]
    return spark.read.parquet(data), rest[0], mo.load_model(artifacts), *rest[1:]


PREDICTED = ["prediction", "PREDICTED_targetVar", *mo.CLASS_OUTPUTS]


def mbt(spark: SparkSession, sf: str) -> DataFrame:
    return _modelled(spark, sf)[0]


def mbt_base(spark: SparkSession, sf: str) -> DataFrame:
    """What of the modelling base table doesn't depend on the forest: base
    columns, label, label index, and the part a customer is in."""
    table = _modelled(spark, sf)[0].drop(*PREDICTED)
    return table.withColumns({c: F.round(c, 6) for c in bt.SALES_IMPUTED.values()})


def mbt_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return mo.evaluate(_modelled(spark, sf)[1])


def mbt_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scored customers of each part, and how many of them have probabilities
    between 0 and 1 that don't add up to more than 1, a predicted class whose
    name is the indexed one, and the largest probability on that class."""
    _, preds, model, *_ = _modelled(spark, sf)
    labels = F.array(*[F.lit(x) for x in model.stages[0].labels])
    probs = [F.coalesce(F.col(c), F.lit(0.0)) for c in mo.CLASS_OUTPUTS]
    own = F.element_at(F.map_from_arrays(F.array(*[F.lit(c) for c in mo.CLASS_OUTPUTS]), F.array(*probs)), F.col("PREDICTED_targetVar"))
    total = reduce(lambda a, b: a + b, probs)
    valid = (total <= 1 + 1e-9) & (F.least(*probs) >= 0) & (F.greatest(*probs) <= F.coalesce(own, F.lit(1.0)))
    named = F.element_at(labels, F.col("prediction").cast("int") + 1) == F.col("PREDICTED_targetVar")
    return preds.groupBy("Holdout").agg(F.count(F.lit(1)).alias("scored"), F.sum(valid.cast("long")).alias("valid"),
                                        F.sum(named.cast("long")).alias("named"))


def model_search(spark: SparkSession, sf: str) -> DataFrame:
    """Every parameter set of the search: its folds, the rows it was validated
    on, and whether it got at most these rows right."""
    scores = _modelled(spark, sf)[5]
    return scores.groupBy("num_trees", "max_depth", "max_bins").agg(
        F.count(F.lit(1)).alias("folds"), F.sum("validated").alias("validated"),
        F.min(F.col("correct").between(0, F.col("validated"))).alias("valid"))


def model_shape(spark: SparkSession, sf: str) -> DataFrame:
    """Classes, width of the assembled vector, total of the importances."""
    model = _modelled(spark, sf)[2]
    forest = mo.best_forest(model)
    return spark.createDataFrame([(len(model.stages[0].labels), forest.numFeatures, round(float(sum(forest.featureImportances.toArray())), 6))],
                                 "classes int, width int, importance double")


def feature_importances(spark: SparkSession, sf: str) -> DataFrame:
    _, _, model, _, abt, _ = _modelled(spark, sf)
    field = mo.assembled_features_field(model, abt.withColumnRenamed(LABEL, mo.LABEL).limit(0))
    rows = me.feature_importances(mo.best_forest(model).featureImportances, field)
    return spark.createDataFrame(rows, "feature string, idx int, score double")


def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Every scored customer, and whether the loaded pipeline gives the scores
    that the fitted one gave."""
    _, preds, model, kept, abt, _ = _modelled(spark, sf)
    data = (abt.filter(F.col(LABEL) != conf.LABEL_EXCLUDED)
            .select("CUSTOMER", *[f for f in kept if f != LABEL], F.col(LABEL).alias(mo.LABEL)))
    again = mo.score(model, data)
    compared = [c for c in again.columns if c != "CUSTOMER"]
    again = again.select("CUSTOMER", F.struct(*compared).alias("again"))
    return preds.join(again, "CUSTOMER", "left").select(
        "CUSTOMER", F.struct(*compared).eqNullSafe(F.col("again")).alias("same"))


QUERIES.update({
    "mbt": mbt,
    "mbt_base": mbt_base,
    "mbt_metrics": mbt_metrics,
    "mbt_scores": mbt_scores,
    "model_search": model_search,
    "model_shape": model_shape,
    "feature_importances": feature_importances,
    "model_roundtrip": model_roundtrip,
})
