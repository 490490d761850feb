"""Scoring and the end-to-end training query on the lineitem fixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.score import score_requests, score_typed
from riskloom.plans import clinical
from riskloom.plans import fixture as fx
from riskloom.plans.jobs import ingest, train
from riskloom.plans.queries.common import FILES_PER_TRIGGER, ROWS_PER_FILE, read_driver_table
from riskloom.plans.queries.clinical import clinical_model
from riskloom.session import shared_path
from riskloom.sources.table import request_frame
from riskloom.specs import DIABETES
from riskloom.streaming import run_scoring_stream


# Fixed literal requests for the one-record path (quantity, discount, tax).
ONE_RECORDS = [(1, "5", "0.04", "0.02"), (2, "17", "0.1", "0.0"), (3, "18", "0.0", "0.08"), (4, "50", "0.07", "0.05")]


def score_one_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-4/P-4: single records (typed tuple + literal label 0) scored by a
    model trained on the whole lineitem train split."""
    model = fx.fitted(spark, sf_dir, "classifier", fx.DEEP, label_kind="separable")
    spec = fx.LINEITEM_RISK
    # the reference parses each form value in Python before building the frame
    typed = [(rid, float(q), float(d), float(t)) for rid, q, d, t in ONE_RECORDS]
    frame = request_frame(spark, spec, typed, id_col="request_id")
    return score_typed(model, frame, spec, keep=["request_id"])


def lineitem_requests(li: DataFrame) -> DataFrame:
    """Text requests (form-like strings) derived from every lineitem row."""
    return li.select(
        "l_orderkey",
        "l_linenumber",
        *[F.col(c).cast("string").alias(c) for c in fx.FEATURES],
    )


def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-1: a table of text requests scored in one lazy, map-only plan."""
    model = fx.fitted(spark, sf_dir, "classifier", fx.STUMP)
    reqs = lineitem_requests(read_driver_table(spark, sf_dir, "lineitem"))
    return score_requests(model, reqs, fx.LINEITEM_RISK, strict=False, keep=["l_orderkey", "l_linenumber"])


def score_batch_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-1/X-1/X-2: text requests with values that cannot be scored: bad
    text, half numbers, suffixes a cast would take, NaN, empty and missing.
    Such rows stay, rejected, without a verdict."""
    model = clinical_model(spark, sf_dir, DIABETES, clinical.diabetes_rows)
    reqs = spoiled_requests(clinical.diabetes_rows(read_driver_table(spark, sf_dir, "orders")))
    return score_requests(model, reqs, DIABETES, strict=False, keep=[clinical.KEY])


def spoiled_requests(rows: DataFrame) -> DataFrame:
    k = F.col(clinical.KEY)
    text = {c: F.col(c).cast("string") for c in DIABETES.features}
    text["Pregnancies"] = F.when(k % 11 == 0, "x").when(k % 13 == 0, F.concat(text["Pregnancies"], F.lit(".5"))).otherwise(text["Pregnancies"])
    text["Glucose"] = F.when(k % 17 == 0, "NaN").when(k % 19 == 0, F.concat(text["Glucose"], F.lit("f"))).otherwise(text["Glucose"])
    text["BMI"] = F.when(k % 23 == 0, "").when(k % 29 == 0, F.lit(None).cast("string")).when(k % 31 == 0, "0x1p3").otherwise(text["BMI"])
    return rows.select(clinical.KEY, *[v.alias(c) for c, v in text.items()])


def score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-2: the same scoring as a file stream (availableNow, checkpointed)."""
    model = fx.fitted(spark, sf_dir, "classifier", fx.STUMP)
    reqs = lineitem_requests(read_driver_table(spark, sf_dir, "lineitem"))
    src = shared_path(spark, "requests")
    # requests arrive as several files
    reqs.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(src)
    return run_scoring_stream(
        spark,
        fx.LINEITEM_RISK,
        model,
        src,
        reqs.schema,
        shared_path(spark, "scored-sink"),
        shared_path(spark, "scored-ckpt"),
        keep=["l_orderkey", "l_linenumber"],
        max_files_per_trigger=FILES_PER_TRIGGER,
    )


def train_eval_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-3: ingest to the store -> read back -> split -> fit -> save ->
    predict -> export predictions -> one row of test metrics."""
    spec = fx.LINEITEM_RISK
    src = fx.lineitem_risk(spark, sf_dir).select(fx.KEY, *spec.features, spec.label)
    data = ingest(spark, spec, src, shared_path(spark, "store-lineitem-risk"), keep=[fx.KEY])
    res = train(
        spark,
        spec,
        data,
        split_key=fx.KEY,
        model_path=shared_path(spark, "model-train-eval"),
        predictions_path=shared_path(spark, "predictions-train-eval"),
        params=fx.STUMP,
    )
    return res.metrics
