"""Decision-tree models: fit, save, load by kind, predict.

Training is MLlib's distributed tree learner: split candidates come from a
bounded sample, per-level statistics are aggregated on executors and only
the (bins x features x nodes) histograms reach the driver.
"""

from __future__ import annotations

import json
import uuid

from pyspark import StorageLevel
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import shared_root
from riskloom.specs import TreeParams

KINDS = ("classifier", "regressor")

_ESTIMATORS = {"classifier": DecisionTreeClassifier, "regressor": DecisionTreeRegressor}
_MODELS = {"classifier": DecisionTreeClassificationModel, "regressor": DecisionTreeRegressionModel}
_CLASS_TO_KIND = {
    "org.apache.spark.ml.classification.DecisionTreeClassificationModel": "classifier",
    "org.apache.spark.ml.regression.DecisionTreeRegressionModel": "regressor",
}


def estimator(kind: str, label: str, params: TreeParams, features_col: str = "features"):
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    est = _ESTIMATORS[kind](
        featuresCol=features_col,
        labelCol=label,
        maxDepth=params.max_depth,
        maxBins=params.max_bins,
        minInstancesPerNode=params.min_instances_per_node,
        minInfoGain=params.min_info_gain,
        seed=params.seed,
        maxMemoryInMB=params.max_memory_mb,
    )
    if params.impurity:
        est = est.setImpurity(params.impurity)
    if params.max_depth > 10:
        # Deep trees: keep node ids cached and checkpointed (to the session's
        # shared checkpoint folder) instead of re-walking the tree per level.
        est = est.setCacheNodeIds(True).setCheckpointInterval(10)
    return est


def with_class_count(df: DataFrame, label: str, num_classes: int) -> DataFrame:
    """Declare the label's class count in column metadata (labels 0..k-1).

    The classifier otherwise runs a separate pass over the data to find the
    largest label. A label outside 0..k-1 still fails the fit.
    """
    meta = {"ml_attr": {"type": "nominal", "num_vals": int(num_classes), "name": label}}
    return df.withColumn(label, F.col(label).cast("double").alias(label, metadata=meta))


def fit_tree(
    df: DataFrame,
    kind: str,
    label: str,
    params: TreeParams = TreeParams(),
    features_col: str = "features",
    persist_input: bool = False,
    num_classes: int | None = None,
):
    """Fit a tree on ``(label, features)``.

    The learner scans its input up to three times (metadata, split sampling,
    binning) and then keeps its own binned copy. ``persist_input`` also keeps
    the assembled input (label + vector) on executors, spilling to disk, for
    the length of the fit: worth it only where the scans are costly and a
    second copy fits. ``num_classes`` (classifier only) declares the label
    domain up front; ``None`` lets MLlib find it with an extra pass.
    """
    data = df.select(label, features_col)
    if kind == "classifier" and num_classes is not None:
        data = with_class_count(data, label, num_classes)
    est = estimator(kind, label, params, features_col)
    if est.getCacheNodeIds():
        shared_root(df.sparkSession)  # node-id checkpoints need the shared folder
    cached = persist_input and not df.is_cached
    if cached:
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return est.fit(data)
    finally:
        if cached:
            data.unpersist()


def save_model(model, path: str, overwrite: bool = False) -> None:
    """Save a model directory; fails if it exists unless ``overwrite``."""
    if overwrite:
        model.write().overwrite().save(path)
    else:
        model.save(path)


def model_kind(spark: SparkSession, path: str) -> str:
    """Read the model class from its metadata before choosing a loader."""
    line = spark.read.text(f"{path.rstrip('/')}/metadata").first()
    cls = json.loads(line[0])["class"]
    try:
        return _CLASS_TO_KIND[cls]
    except KeyError:
        raise ValueError(f"not a decision-tree model: {cls}") from None


def load_model(spark: SparkSession, path: str, kind: str | None = None):
    if kind is None:
        kind = model_kind(spark, path)
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    return _MODELS[kind].load(path)


PUBLISHED = "version long, folder string"


def publish_model(model, path: str, spark: SparkSession | None = None) -> str:
    """Save a model beside the earlier ones below ``path`` and make it the current one.

    The model is written in full to a folder of its own; a row appended to
    the table of published versions then names it. Spark commits that append
    as a whole, so a reader sees the old or the new model, never a part or
    none, and nothing is deleted under a scorer that still reads. A publisher
    that fails before the append leaves an unnamed folder behind. Of two that
    publish at once, both are kept and the folder's name decides.
    """
    spark = spark or SparkSession.active()
    folder = uuid.uuid4().hex
    model.save(f"{path.rstrip('/')}/models/{folder}")
    last = _published(spark, path)
    row = [(0 if last is None else last["version"] + 1, folder)]
    spark.createDataFrame(row, PUBLISHED).coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/published")
    return folder


def _published(spark: SparkSession, path: str):
    """The latest row of the published versions, or None before the first."""
    table = f"{path.rstrip('/')}/published"
    try:
        rows = spark.read.schema(PUBLISHED).parquet(table)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.agg(F.max(F.struct("version", "folder")).alias("last")).first()["last"]


def current_model(spark: SparkSession, path: str, kind: str | None = None):
    """The model published last below ``path``; a stream calls it once a micro-batch."""
    last = _published(spark, path)
    if last is None:
        raise ValueError(f"no model is published below {path}")
    return load_model(spark, f"{path.rstrip('/')}/models/{last['folder']}", kind)


def predict(model, df: DataFrame) -> DataFrame:
    """Adds ``prediction`` (and for classifiers ``rawPrediction``/``probability``)."""
    return model.transform(df)


COMPILED_DEPTH = 10  # at most 1,023 comparisons in one expression


def compiled_prediction(model, features: list[str]) -> Column:
    """A fitted tree's prediction as one nested expression over its feature columns.

    The same value as ``transform``'s on every row, without a vector or a
    model call, so scoring stays in one generated stage. NULL and NaN go to
    the right child, as NaN does in the model. ``features`` are in the order
    the tree was trained on; a tree that splits on categories or is deeper
    than ``COMPILED_DEPTH`` raises.
    """
    if model.numFeatures != len(features):
        raise ValueError(f"the model has {model.numFeatures} features, {len(features)} columns are given")
    if model.depth > COMPILED_DEPTH:
        raise ValueError(f"a tree of depth {model.depth} is not compiled; use predict")

    def value(node) -> Column:
        if node.subtreeDepth() == 0:
            return F.lit(float(node.prediction()))
        split = node.split()
        if not split.getClass().getSimpleName().startswith("Continuous"):
            raise ValueError("a tree with categorical splits is not compiled; use predict")
        column = F.col(features[split.featureIndex()]).cast("double")
        return F.when(column <= F.lit(float(split.threshold())), value(node.leftChild())).otherwise(value(node.rightChild()))

    return value(model._call_java("rootNode"))
