"""Metrics: accuracy, percent, confusion counts.

All are global or tiny-keyed aggregates: each task pre-aggregates its rows
(partial aggregation), so only one small row per task crosses the shuffle.
"""

from __future__ import annotations

import math

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import accuracy_percent


def correct_flag(label: str, prediction: str = "prediction"):
    return (F.col(prediction) == F.col(label).cast("double")).cast("double")


def accuracy(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: share of the labelled rows whose (unrounded) prediction equals the label.

    Rows without a label do not count. NULL if there is no labelled row.
    """
    return df.agg(F.avg(correct_flag(label, prediction)).alias("accuracy"))


def accuracy_report(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: ``accuracy`` and ``accuracy_percent`` (ceil of accuracy * 100)."""
    acc = accuracy(df, label, prediction)
    return acc.select("accuracy", accuracy_percent("accuracy").alias("accuracy_percent"))


def confusion(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Counts per (prediction, label); at most classes^2 rows."""
    return df.groupBy(
        F.col(prediction).alias("prediction"), F.col(label).alias("label")
    ).agg(F.count(F.lit(1)).alias("n"))


def evaluator_accuracy(df: DataFrame, label: str, prediction: str = "prediction") -> float | None:
    """The reference's evaluator call; returns None where it would give NaN."""
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName="accuracy")
    value = ev.evaluate(df.withColumn(label, F.col(label).cast("double")))
    return None if value is None or math.isnan(value) else value
