"""Tree queries: fit, predict, probability, save/load, pairs, accuracy."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import round_half_even
from riskloom.operators.evaluate import accuracy, accuracy_report, confusion, evaluator_accuracy
from riskloom.operators.model import compiled_prediction, load_model, save_model
from riskloom.operators.prepare import hash_split
from riskloom.operators.quantiles import fit_quantile_tree
from riskloom.operators.score import rounded_pairs
from riskloom.plans import fixture as fx
from riskloom.plans.jobs import train
from riskloom.plans.queries.common import read_driver_table
from riskloom.session import shared_path, table_path


def _test_confusion(scored: DataFrame) -> DataFrame:
    pairs = rounded_pairs(scored, fx.LABEL)
    return confusion(pairs, "label")


def dt_classifier_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-1 depth 0: every row gets the training majority class."""
    model = fx.fitted(spark, sf_dir, "classifier", fx.MAJORITY)
    return _test_confusion(fx.scored_test(spark, sf_dir, model))


def dt_classifier_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-1/T-3 depth 1 (gini): test-set confusion counts."""
    model = fx.fitted(spark, sf_dir, "classifier", fx.STUMP)
    return _test_confusion(fx.scored_test(spark, sf_dir, model))


def dt_classifier_separable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-1 depth 5 on a separable label: every test prediction is right."""
    model = fx.fitted(spark, sf_dir, "classifier", fx.DEEP, label_kind="separable")
    scored = fx.scored_test(spark, sf_dir, model, label_kind="separable")
    return rounded_pairs(scored, fx.LABEL, keep=["l_orderkey", "l_linenumber", "l_quantity"])


def dt_classifier_depth2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-1 depth 2 (gini): every test row's prediction from a two-level tree."""
    model = fx.fitted(spark, sf_dir, "classifier", fx.DEPTH2)
    scored = fx.scored_test(spark, sf_dir, model)
    return rounded_pairs(scored, fx.LABEL, keep=["l_orderkey", "l_linenumber", *fx.FEATURES])


def dt_classifier_depth5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-1 at the reference's depth (5, gini): every test row's prediction."""
    model = fx.fitted(spark, sf_dir, "classifier", fx.DEEP)
    scored = fx.scored_test(spark, sf_dir, model)
    return rounded_pairs(scored, fx.LABEL, keep=["l_orderkey", "l_linenumber", *fx.FEATURES])


def dt_classifier_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-1 with the learner's defaults (depth 5, 32 bins, gini) on coded columns."""
    model = fx.fitted(spark, sf_dir, "classifier", fx.DEFAULTS, label_kind="coded")
    scored = fx.scored_test(spark, sf_dir, model, label_kind="coded")
    return rounded_pairs(scored, fx.LABEL, keep=["l_orderkey", "l_linenumber", "l_discount", "l_tax"])


def _regressor_output(scored: DataFrame) -> DataFrame:
    return scored.groupBy(
        F.round("prediction", 6).alias("prediction"), F.col(fx.LABEL).alias("label")
    ).agg(F.count(F.lit(1)).alias("n"))


def dt_regressor_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-2 depth 0: the prediction is the training label mean."""
    model = fx.fitted(spark, sf_dir, "regressor", fx.MAJORITY)
    return _regressor_output(fx.scored_test(spark, sf_dir, model))


def dt_regressor_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-2 depth 1 (variance): raw, unrounded leaf means on the test set."""
    model = fx.fitted(spark, sf_dir, "regressor", fx.STUMP)
    return _regressor_output(fx.scored_test(spark, sf_dir, model))


def dt_regressor_depth2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-2 depth 2 (variance): leaf means of a two-level regression tree."""
    model = fx.fitted(spark, sf_dir, "regressor", fx.DEPTH2)
    return _regressor_output(fx.scored_test(spark, sf_dir, model))


def dt_regressor_depth5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-2 at the reference's depth (5, variance): leaf means on the test set."""
    model = fx.fitted(spark, sf_dir, "regressor", fx.DEEP)
    return _regressor_output(fx.scored_test(spark, sf_dir, model))


def dt_regressor_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-2 with the learner's defaults (depth 5, 32 bins, variance): raw scores."""
    model = fx.fitted(spark, sf_dir, "regressor", fx.DEFAULTS, label_kind="coded")
    return _regressor_output(fx.scored_test(spark, sf_dir, model, label_kind="coded"))


def predict_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-3: class probabilities of the stump's leaves."""
    model = fx.fitted(spark, sf_dir, "classifier", fx.STUMP)
    scored = fx.scored_test(spark, sf_dir, model)
    prob = vector_to_array("probability")
    return scored.groupBy(
        round_half_even("prediction").alias("prediction"),
        F.round(prob[0], 6).alias("p0"),
        F.round(prob[1], 6).alias("p1"),
    ).agg(F.count(F.lit(1)).alias("n"))


def _roundtrip(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    model = fx.fitted(spark, sf_dir, kind, fx.STUMP)
    path = shared_path(spark, f"model-{kind}")
    save_model(model, path)  # first save: path is new
    save_model(model, path, overwrite=True)  # second save replaces it
    loaded = load_model(spark, path)  # class read from the metadata
    scored = fx.scored_test(spark, sf_dir, loaded)
    return _test_confusion(scored) if kind == "classifier" else _regressor_output(scored)


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-3/K-4/S-5: save, overwrite, load, predict (classifier)."""
    return _roundtrip(spark, sf_dir, "classifier")


def model_roundtrip_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-6: the same for a regression tree."""
    return _roundtrip(spark, sf_dir, "regressor")


def stump_pairs(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    model = fx.fitted(spark, sf_dir, "classifier", fx.STUMP)
    return rounded_pairs(fx.scored_test(spark, sf_dir, model), fx.LABEL, keep=keep)


def prediction_label_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R-1/R-3/P-3: one (prediction, label) row per test row."""
    return stump_pairs(spark, sf_dir)


def accuracy_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-1: share of test rows predicted right."""
    model = fx.fitted(spark, sf_dir, "classifier", fx.STUMP)
    acc = accuracy(fx.scored_test(spark, sf_dir, model), fx.LABEL)
    return acc.select(F.round("accuracy", 6).alias("accuracy"))


def accuracy_evaluator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-1 by the evaluator call, next to the test rows it covers."""
    scored = fx.scored_test(spark, sf_dir, fx.fitted(spark, sf_dir, "classifier", fx.STUMP))
    value = evaluator_accuracy(scored, fx.LABEL)
    return scored.agg(F.count(F.lit(1)).alias("n_test"), F.round(F.lit(value), 6).alias("accuracy"))


def _continuous(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    price, key = F.col("l_extendedprice"), F.col(fx.KEY)
    label = (price + key % 7 * 1000 > 38000).cast("int").alias(fx.LABEL)
    rows = read_driver_table(spark, sf_dir, "lineitem").select(fx.KEY, "l_linenumber", *fx.CONTINUOUS_FEATURES, label)
    train_rows, test_rows = hash_split(rows, fx.KEY, fx.TRAIN_FRACTION)
    model = fit_quantile_tree(train_rows, fx.CONTINUOUS_FEATURES, kind, fx.LABEL, fx.DEFAULTS, num_classes=2)
    return test_rows.withColumn("prediction", compiled_prediction(model, fx.CONTINUOUS_FEATURES))


def dt_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-1 on columns with more values than bins: exact quantile cuts, every test row's prediction."""
    return rounded_pairs(_continuous(spark, sf_dir, "classifier"), fx.LABEL, keep=[fx.KEY, "l_linenumber"])


def dt_continuous_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-2 on the same columns and cuts: raw leaf means on the test set."""
    return _regressor_output(_continuous(spark, sf_dir, "regressor"))


def train_three_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-3 with a label of three classes, their number found by the learner;
    the exported predictions carry the key columns."""
    q = F.col("l_quantity")
    rows = spark.read.parquet(table_path(sf_dir, "lineitem")).select(
        "l_orderkey", "l_linenumber", *fx.FEATURES, F.when(q <= 17, 0).when(q <= 34, 1).otherwise(2).alias(fx.LABEL)
    )
    spec = replace(fx.LINEITEM_RISK, name="lineitem_three", num_classes=None, params=fx.DEEP)
    res = train(spark, spec, rows, fx.KEY, predictions_path=shared_path(spark, "predictions-three"), keep=["l_orderkey", "l_linenumber"])
    return res.predictions


def accuracy_percent_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-2: accuracy percent, rounded up."""
    model = fx.fitted(spark, sf_dir, "classifier", fx.STUMP)
    rep = accuracy_report(fx.scored_test(spark, sf_dir, model), fx.LABEL)
    return rep.select(F.round("accuracy", 6).alias("accuracy"), "accuracy_percent")
