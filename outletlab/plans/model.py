"""Modelling base table: label indexing, one-hot encoding, vector assembly,
random forest with a cross-validated parameter grid (plans/forest_search.py),
predictions for the train and test parts, class probabilities by class name, joined back to the
base table; save / load of the fitted pipeline and the table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import PipelineSharedReadWrite
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outletlab import conf
from outletlab.operators import select as sel
from outletlab.plans import forest_search as fos
from outletlab.session import copy_folder, cut_lineage, drop_folder, free_driver
from outletlab.sources.files import load_latest_csv

LABEL = "targetVar"
LABEL_INDEX = "targetVarInd"
CLASS_OUTPUTS = ["Iron", "Bronze", "Silver", "Gold"]
PARTITION_BYTES = 32 << 20  # of dense vectors in one partition of the training copy


@dataclass
class ModelConfig:
    """The search: by default all 100 parameter sets on 5 folds."""

    num_trees: list = field(default_factory=lambda: list(conf.GRID_NUM_TREES))
    max_depth: list = field(default_factory=lambda: list(conf.GRID_MAX_DEPTH))
    max_bins: list = field(default_factory=lambda: list(conf.GRID_MAX_BINS))
    folds: int = conf.CV_FOLDS
    parallelism: int = 8
    train_fraction: float = conf.TRAIN_FRACTION


def split_feature_types(df: DataFrame, exclude=(LABEL, "CUSTOMER")) -> tuple:
    """(continuous, categorical) column lists from the schema (metadata only)."""
    continuous = [c for c, t in df.dtypes if c not in exclude and t in ("int", "double", "bigint")]
    categorical = [c for c, t in df.dtypes if c not in exclude and t == "string"]
    return continuous, categorical


def feature_pipeline(categorical, continuous) -> Pipeline:
    """Label index, one-hot categories and the assembled vector."""
    indexed = [f"{c}_indexed" for c in categorical]
    stages = [StringIndexer(inputCol=LABEL, outputCol=LABEL_INDEX)]
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"))
        encoded = [f"{c}_encoded" for c in indexed]
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=False))
    else:
        encoded = []
    stages.append(VectorAssembler(inputCols=encoded + list(continuous), outputCol="features",
                                  handleInvalid="skip"))
    return Pipeline(stages=stages)


def fit_model(train: DataFrame, categorical, continuous, cfg: ModelConfig, key: str = "CUSTOMER") -> tuple:
    """(pipeline with the forest of the best parameter set, search scores).

    The vectors are stored once, in as many files as their size asks for: every
    level of every tree is a job over them. A row's fold is a hash of its key.
    """
    prepared = feature_pipeline(categorical, continuous).fit(train)
    fold = F.pmod(F.xxhash64(key, F.lit(conf.CV_SEED)), F.lit(cfg.folds)).cast("int").alias("fold")
    vectors = prepared.transform(train).select(key, LABEL_INDEX, "features", fold)
    width = vectors.schema["features"].metadata["ml_attr"]["num_attrs"]
    parts = -(-vectors.count() * width * 8 // PARTITION_BYTES) or 1
    vectors = cut_lineage(vectors.repartition(parts, key), "model_vectors")
    scores = cut_lineage(fos.nested_search(vectors, LABEL_INDEX, "features", "fold", cfg.folds, cfg.num_trees, cfg.max_depth,
                                           cfg.max_bins, conf.FOREST_SEED, cfg.parallelism, -(-parts // cfg.folds)), "search_scores")
    forest = RandomForestClassifier(labelCol=LABEL_INDEX, featuresCol="features", seed=conf.FOREST_SEED, cacheNodeIds=True, **fos.best_set(scores))
    free_driver(train.sparkSession)
    return PipelineModel(stages=[*prepared.stages, fos.fit_forest(forest, vectors)]), scores


def select_features(abt: DataFrame, features, label: str = "CUST_CCAF_GROUP",
                    alpha: float = conf.CHI_SQUARE_ALPHA,
                    threshold: float = conf.ASSOCIATION_THRESHOLD) -> list:
    """Features significant by chi-square and not too associated with an
    earlier one. Returns the kept names (a list of column names is all that
    reaches the driver). It is an error if no feature is significant: there
    is nothing to learn from."""
    chi = sel.chi_square(abt, features, label, alpha)
    important = {r["feature"] for r in chi.filter("important").select("feature").collect()}
    important = [f for f in features if f in important]
    if not important:
        raise ValueError(f"none of {len(features)} features is significant for {label} at {alpha}")
    if len(important) < 2:
        return important
    pruned = sel.association_prune(sel.associations(abt, important), important, threshold)
    dropped = {r["feature"] for r in pruned.filter("dropped").select("feature").collect()}
    return [f for f in important if f not in dropped]


def model_base_table(abt: DataFrame, features, label: str = "CUST_CCAF_GROUP", key: str = "CUSTOMER",
                     cfg: ModelConfig | None = None) -> tuple:
    """Fit on a stratified train part and return (mbt, predictions, model, scores).

    ``predictions`` has one row per labelled customer that could be scored
    (rows with a missing continuous feature are skipped by the assembler):
    CUSTOMER, prediction, PREDICTED_targetVar, labelCol, labelIndCol, one
    probability column per class name, Holdout ('Train' / 'Test').
    """
    cfg = cfg or ModelConfig()
    data = (abt.filter(F.col(label) != conf.LABEL_EXCLUDED)
            .select(key, *[f for f in features if f != label], F.col(label).alias(LABEL)))
    # the fit makes many passes (indexers, folds, tree levels): read a written copy
    data = cut_lineage(data, "model_input")
    continuous, categorical = split_feature_types(data, exclude=(LABEL, key))
    train, test = sel.stratified_split_train_test(data, cfg.train_fraction, LABEL, key)
    model, scores = fit_model(train, categorical, continuous, cfg, key)
    preds = score(model, train, key).withColumn("Holdout", F.lit("Train")).unionByName(
        score(model, test, key).withColumn("Holdout", F.lit("Test")))
    # scored once: the table, the metrics and the saved copy all read this
    preds = cut_lineage(preds, "predictions")
    return abt.join(preds, key, "left"), preds, model, scores


def score(model: PipelineModel, data: DataFrame, key: str = "CUSTOMER") -> DataFrame:
    """Predictions of a fitted (or loaded) pipeline for labelled rows; rows
    of the class left out of the report are dropped."""
    labels = list(model.stages[0].labels)
    scored = model.transform(data).filter(F.col(LABEL) != conf.PREDICTION_EXCLUDED)
    scored = IndexToString(inputCol="prediction", outputCol="predictionLabel", labels=labels).transform(scored)
    probs = vector_to_array("probability")
    return scored.select(
        key, "prediction", F.col("predictionLabel").alias("PREDICTED_targetVar"),
        F.col(LABEL).alias("labelCol"), F.col(LABEL_INDEX).alias("labelIndCol"),
        *[(probs[labels.index(name)] if name in labels else F.lit(None).cast("double")).alias(name)
          for name in CLASS_OUTPUTS])


def best_forest(model: PipelineModel):
    return model.stages[-1]


def assembled_features_field(model: PipelineModel, sample: DataFrame):
    """Schema field of the assembled vector (carries the attribute names)."""
    upto = PipelineModel(stages=model.stages[:-1])
    return upto.transform(sample).schema["features"]


class _StoredStage:
    """A stage that is saved by copying what is stored of it."""

    def __init__(self, stage):
        self.uid, self.stored_at = stage.uid, stage.stored_at

    def write(self):
        return self

    def session(self, spark):
        self.spark = spark
        return self

    def save(self, path: str) -> None:
        copy_folder(self.spark, self.stored_at, path)


def save_model(model: PipelineModel, mbt: DataFrame, artifact_dir: str, data_dir: str) -> tuple:
    """A forest grown on the executors is stored already; to write it anew
    MLlib would bring all its nodes together in the driver once more."""
    if hasattr(best_forest(model), "stored_at"):
        drop_folder(mbt.sparkSession, artifact_dir)
        PipelineSharedReadWrite.saveImpl(model, [*model.stages[:-1], _StoredStage(best_forest(model))], mbt.sparkSession, artifact_dir)
    else:
        model.write().overwrite().save(artifact_dir)
    mbt.write.mode("overwrite").parquet(data_dir)
    return artifact_dir, data_dir


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def cast_to_double(df: DataFrame, columns) -> DataFrame:
    """Named columns as double (NULL where a value does not parse)."""
    wanted = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast("double") for c in wanted})


def load_base_table(spark, snapshot_root: str) -> DataFrame:
    """The newest base table stored under ``snapshot_root``, typed for
    modelling: the listed columns are numbers, all else is text."""
    return cast_to_double(load_latest_csv(spark, snapshot_root), conf.MODEL_DOUBLE_COLUMNS)


def evaluate(preds: DataFrame) -> DataFrame:
    """Metric table per Holdout from the prediction columns of
    ``model_base_table``: accuracy, weighted precision / recall / f1 on the
    label index, the prevalence-weighted one-vs-rest AUC of the per-class
    probability columns, and the mean one-vs-one AUC."""
    from outletlab.operators import metrics as me

    table = me.metric_table(preds, label="labelIndCol", prediction="prediction", score=None)
    auc = me.auc_from_class_scores(preds, "labelCol", {c: c for c in CLASS_OUTPUTS}, by="Holdout")
    prev = preds.groupBy("Holdout", F.col("labelCol").alias("class")).agg(F.count(F.lit(1)).alias("k"))
    auc = auc.join(prev, ["Holdout", "class"]).groupBy("Holdout").agg(
        (F.sum(F.col("auc") * F.col("k")) / F.sum("k")).alias("auc"))
    ovo = me.auc_one_vs_one(preds, "labelCol", {c: c for c in CLASS_OUTPUTS}, by="Holdout")
    return table.join(auc, "Holdout", "left").join(ovo.withColumnRenamed("auc", "auc_ovo"), "Holdout", "left")


def run_modelling(abt: DataFrame, features, cfg: ModelConfig | None = None,
                  artifact_dir: str | None = None, data_dir: str | None = None) -> tuple:
    """Modelling entry point: cast inputs (``load_base_table`` gives the newest
    stored ones), select features, fit, score, evaluate and (optionally) save.
    Returns (mbt, metrics, model)."""
    abt = cast_to_double(abt, conf.MODEL_DOUBLE_COLUMNS)
    kept = select_features(abt, features)
    mbt, preds, model, _ = model_base_table(abt, kept, cfg=cfg)
    metrics = evaluate(preds)
    if artifact_dir and data_dir:
        save_model(model, mbt, artifact_dir, data_dir)
    return mbt, metrics, model
