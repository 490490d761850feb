"""End-to-end jobs, parameterised by a ``DatasetSpec``.

ingest : typed source -> append to the store -> read back -> cast projection
train  : store -> assemble -> hash split -> fit -> save -> predict -> metrics
         and predictions export (distributed CSV writer)
score  : text requests -> parse -> assemble -> load model -> predict -> verdict

Writing the store and reading it back also cuts the lineage: the training
plan starts at the written table, not at the original source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from riskloom.functions import accuracy_percent
from riskloom.operators.model import fit_tree, load_model, save_model
from riskloom.operators.prepare import assemble, cast_project, hash_split, random_split
from riskloom.operators.score import rounded_pairs, score_requests
from riskloom.sinks import CRLF, append_table, write_predictions_csv
from riskloom.sources.csv import read_csv_inferred, read_csv_typed
from riskloom.sources.table import read_table
from riskloom.specs import DatasetSpec, TreeParams

PAIRS_SCHEMA = StructType([StructField("prediction", IntegerType()), StructField("label", IntegerType())])
RAW_PAIRS_SCHEMA = StructType([StructField("prediction", DoubleType()), StructField("label", IntegerType())])

SPLITS = ("hash", "random")


def ingest(
    spark: SparkSession,
    spec: DatasetSpec,
    source: DataFrame | str,
    store_path: str | None = None,
    fmt: str = "parquet",
    keep: list[str] | None = None,
    infer_schema: bool = False,
    partitions: int | None = None,
    **store_options: str,
) -> DataFrame:
    """Append the source to the store and return the whole store, typed.

    ``source`` is a typed frame or a CSV path (header; read under the spec
    schema, or with inferred types and then cast to it by name when
    ``infer_schema``, which costs an extra pass). The store is
    ``store_path`` or, when neither a path nor format options are given, the
    catalog table named by the spec. It is append-only: every run adds its
    rows again. ``partitions`` deals the source out to that many files; left
    out, files follow the source's own splits and nothing is shuffled.
    """
    keep = list(keep or [])
    if isinstance(source, str) and infer_schema:
        source = cast_project(read_csv_inferred(spark, source), spec.schema)
    elif isinstance(source, str):
        source = read_csv_typed(spark, source, spec.schema)
    if partitions:
        source = source.repartition(partitions)
    table = spec.table if store_path is None and not store_options else None
    append_table(source, store_path, fmt, table=table, **store_options)
    stored = read_table(spark, store_path, fmt, table=table, **store_options)
    return typed_rows(stored, spec, keep)


def typed_rows(rows: DataFrame, spec: DatasetSpec, keep: list[str] | None = None) -> DataFrame:
    """Key columns as they are (e.g. a record id) and the spec's columns cast to its types."""
    kept = [rows.schema[k] for k in keep or [] if k not in spec.schema.names]
    return cast_project(rows, StructType([*kept, *spec.schema.fields]))


@dataclass
class TrainResult:
    model: object
    predictions: DataFrame  # test rows: keep cols, prediction (int), label
    metrics: DataFrame  # one row


def metrics_frame(scored: DataFrame, label: str) -> DataFrame:
    """One row of test metrics from the scored test set, in one aggregation.

    Rows without a label are counted apart (``n_null_label``); every other
    figure is over the labelled rows.
    """
    p = F.col("prediction")
    y = F.col(label).cast("double")
    correct = (p == y).cast("long")
    out = scored.agg(
        F.count(y).alias("n_test"),
        F.count(F.when(y.isNull(), 1)).alias("n_null_label"),
        F.coalesce(F.sum(correct), F.lit(0)).cast("long").alias("n_correct"),
        F.count(F.when((p == 0) & (y == 0), 1)).alias("tn"),
        F.count(F.when((p == 1) & (y == 0), 1)).alias("fp"),
        F.count(F.when((p == 0) & (y == 1), 1)).alias("fn"),
        F.count(F.when((p == 1) & (y == 1), 1)).alias("tp"),
        F.avg(correct.cast("double")).alias("accuracy_raw"),
    )
    return out.select(
        "n_test",
        "n_null_label",
        "n_correct",
        "tn",
        "fp",
        "fn",
        "tp",
        F.round("accuracy_raw", 6).alias("accuracy"),
        accuracy_percent("accuracy_raw").alias("accuracy_percent"),
    )


def train(
    spark: SparkSession,
    spec: DatasetSpec,
    data: DataFrame,
    split_key: str | list[str] | None = None,
    model_path: str | None = None,
    predictions_path: str | None = None,
    kind: str | None = None,
    params: TreeParams | None = None,
    train_fraction: float = 0.8,
    overwrite: bool = False,
    keep: list[str] | None = None,
    split_hash: str = "md5",
    split: str = "hash",
    seed: int = 42,
) -> TrainResult:
    """Fit on the training side of a split, evaluate on the other side.

    ``data`` is cast to the spec's types first, so a store of strings trains
    too. ``split`` is ``hash`` (of ``split_key``, the spec's columns by
    default) or ``random`` (seeded; stable for one layout of the store).
    Saving the model fails if ``model_path`` exists unless ``overwrite``.
    """
    if split not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS}")
    kind = kind or spec.model_kind
    params = params or spec.params
    keep = list(keep or [])
    split_key = split_key or [f.name for f in spec.schema.fields]
    keys = [split_key] if isinstance(split_key, str) else list(split_key)
    data = typed_rows(data, spec, [*dict.fromkeys([*keep, *(keys if split == "hash" else [])])])
    # split before assembling, so the filter sits next to the scan
    if split == "hash":
        train_rows, test_rows = hash_split(data, keys, train_fraction, split_hash)
    else:
        train_rows, test_rows = random_split(data, [train_fraction, 1.0 - train_fraction], seed)
    model = fit_tree(assemble(train_rows, spec.features), kind, spec.label, params, num_classes=spec.num_classes)
    if model_path:
        save_model(model, model_path, overwrite=overwrite)
    scored = model.transform(assemble(test_rows, spec.features))
    if kind == "regressor":
        # regression scores are exported raw (no rounding), as the offline
        # trainers do; metrics use their half-even rounding
        pairs = scored.select(*keep, "prediction", F.col(spec.label).alias("label"))
        schema = RAW_PAIRS_SCHEMA
    else:
        pairs = rounded_pairs(scored, spec.label, keep=keep)
        schema = PAIRS_SCHEMA
    if not predictions_path:
        return TrainResult(model, pairs, metrics_frame(_rounded(scored), spec.label))
    write_predictions_csv(pairs, predictions_path, (*keep, "prediction", "label"))
    schema = StructType([*(data.schema[k] for k in keep), *schema.fields])
    # Metrics come from the written file, so the test side is scanned and
    # scored once. For a classifier the rounded prediction equals the raw one.
    written = read_csv_typed(spark, predictions_path, schema, lineSep=CRLF)
    return TrainResult(model, written, metrics_frame(_rounded(written), "label"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", F.bround(F.col("prediction").cast("double"), 0))


def score(
    spark: SparkSession,
    spec: DatasetSpec,
    requests: DataFrame,
    model_path: str,
    strict: bool = False,
    keep: list[str] | None = None,
) -> DataFrame:
    model = load_model(spark, model_path, None)
    return score_requests(model, requests, spec, strict=strict, keep=keep)
