"""The reference's flows on its two clinical schemas (rows derived from orders)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskloom.operators.model import fit_tree, load_model, save_model
from riskloom.operators.prepare import assemble, hash_split_flag
from riskloom.operators.score import score_requests, score_routed as route, score_typed
from riskloom.plans import clinical
from riskloom.plans import fixture as fx
from riskloom.plans.jobs import ingest, train
from riskloom.plans.queries.common import FILES_PER_TRIGGER, ROWS_PER_FILE, read_driver_table
from riskloom.session import data_version, session_key, shared_path
from riskloom.sources.csv import header_schema
from riskloom.sources.table import parse_form, read_table, request_frame
from riskloom.sinks import append_table
from riskloom.specs import DIABETES, HEART
from riskloom.streaming import run_scoring_stream


def _train_eval_clinical(spark: SparkSession, sf_dir: str, spec, rows, kind: str = "classifier") -> DataFrame:
    """The reference's training flow on a clinical schema, learner defaults
    (depth 5, 32 bins): ingest -> store -> split -> fit -> save -> export ->
    metrics."""
    src = rows(read_driver_table(spark, sf_dir, "orders"))
    data = ingest(spark, spec, src, shared_path(spark, f"store-{spec.name}"), keep=[clinical.KEY])
    res = train(
        spark,
        spec,
        data,
        split_key=clinical.KEY,
        model_path=shared_path(spark, f"model-{spec.name}-{kind}"),
        predictions_path=shared_path(spark, f"predictions-{spec.name}-{kind}"),
        kind=kind,
        params=fx.DEFAULTS,
    )
    return res.metrics


def train_eval_string_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-3 from a store that holds text: the training job casts what it reads."""
    rows = clinical.diabetes_rows(read_driver_table(spark, sf_dir, "orders"))
    store = shared_path(spark, "store-text")
    append_table(rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns]), store)
    res = train(spark, DIABETES, read_table(spark, store), split_key=clinical.KEY, params=fx.DEFAULTS)
    return res.metrics


def train_eval_diabetes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-3 on the diabetes schema (8 features), classification tree."""
    return _train_eval_clinical(spark, sf_dir, DIABETES, clinical.diabetes_rows)


def train_eval_heart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-3 on the heart schema (13 features), classification tree."""
    return _train_eval_clinical(spark, sf_dir, HEART, clinical.heart_rows)


def train_eval_diabetes_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offline trainer's path: regression tree, raw scores exported,
    metrics on their half-even rounding."""
    return _train_eval_clinical(spark, sf_dir, DIABETES, clinical.diabetes_rows, kind="regressor")


def train_eval_heart_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offline trainer's path on the heart schema (regression tree)."""
    return _train_eval_clinical(spark, sf_dir, HEART, clinical.heart_rows, kind="regressor")


_CLINICAL_MODELS: dict[tuple, object] = {}


def clinical_model(spark: SparkSession, sf_dir: str, spec, rows):
    """Default tree on the training side of the clinical rows (fit once per session)."""
    orders = read_driver_table(spark, sf_dir, "orders")
    key = (session_key(spark), data_version(orders), spec.name)
    if key not in _CLINICAL_MODELS:
        data = rows(orders)
        train_rows = data.where(hash_split_flag(clinical.KEY, 0.8))
        vec = assemble(train_rows, spec.features, keep=[spec.label])
        _CLINICAL_MODELS[key] = fit_tree(vec, "classifier", spec.label, fx.DEFAULTS, num_classes=2)
    return _CLINICAL_MODELS[key]


def _score_clinical(spark: SparkSession, sf_dir: str, spec, rows) -> DataFrame:
    model = clinical_model(spark, sf_dir, spec, rows)
    reqs = clinical.text_requests(rows(read_driver_table(spark, sf_dir, "orders")), spec)
    return score_requests(model, reqs, spec, strict=False, keep=[clinical.KEY])


def _score_one_clinical(spark: SparkSession, sf_dir: str, spec, rows, forms) -> DataFrame:
    """The single-user endpoint: form text -> typed one-row frames with the
    placeholder label -> model loaded from disk -> rounded -> verdict."""
    path = shared_path(spark, f"model-{spec.name}-serving")
    save_model(clinical_model(spark, sf_dir, spec, rows), path)
    model = load_model(spark, path)  # class read from the saved metadata
    typed = [(rid, *parse_form(spec, vals)) for rid, vals in forms]
    frame = request_frame(spark, spec, typed, id_col="request_id")
    return score_typed(model, frame, spec, keep=["request_id"])


def score_one_diabetes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-4/S-5/P-4/X-3: diabetes form submissions."""
    return _score_one_clinical(spark, sf_dir, DIABETES, clinical.diabetes_rows, clinical.DIABETES_FORMS)


def score_one_heart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-4/S-5/P-4/X-4: heart form submissions."""
    return _score_one_clinical(spark, sf_dir, HEART, clinical.heart_rows, clinical.HEART_FORMS)


def score_stream_heart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-2 on the heart schema: every order arrives as a line of form text in
    CSV files; the stream scores them (availableNow, checkpointed)."""
    model = clinical_model(spark, sf_dir, HEART, clinical.heart_rows)
    reqs = clinical.text_requests(clinical.heart_rows(read_driver_table(spark, sf_dir, "orders")), HEART)
    src = shared_path(spark, "heart-requests")
    # several files, in another column order than the spec's: the stream binds by name
    names = [*HEART.features[::-1], clinical.KEY]
    reqs.select(*names).write.option("maxRecordsPerFile", ROWS_PER_FILE).option("header", "true").csv(src)
    text = header_schema(spark, src, names)
    schema = StructType([StructField(f.name, LongType() if f.name == clinical.KEY else f.dataType) for f in text])
    return run_scoring_stream(
        spark,
        HEART,
        model,
        src,
        schema,
        shared_path(spark, "heart-verdicts"),
        shared_path(spark, "heart-ckpt"),
        keep=[clinical.KEY],
        fmt="csv",
        max_files_per_trigger=FILES_PER_TRIGGER,
    )


def score_diabetes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-1 + X-3: every order as a diabetes request, scored, diabetes verdicts."""
    return _score_clinical(spark, sf_dir, DIABETES, clinical.diabetes_rows)


def score_heart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-1 + X-4: every order as a heart request, scored, heart verdicts."""
    return _score_clinical(spark, sf_dir, HEART, clinical.heart_rows)


def score_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-4 + M-1: one table with a diabetes request, a heart request and, for
    some orders, one of an unknown dataset, each scored by its own model."""
    orders = read_driver_table(spark, sf_dir, "orders")
    routes, requests = {}, orders.where(F.col(clinical.KEY) % 10 == 0).select(clinical.KEY, F.lit("unknown").alias("dataset"), F.create_map(F.lit("age"), F.lit("5")).alias("form"))
    for spec, rows in ((DIABETES, clinical.diabetes_rows), (HEART, clinical.heart_rows)):
        routes[spec.name] = (spec, clinical_model(spark, sf_dir, spec, rows))
        text = clinical.text_requests(rows(orders), spec)
        form = F.create_map(*[x for c in spec.features for x in (F.lit(c), F.col(c))])
        requests = requests.unionByName(text.select(clinical.KEY, F.lit(spec.name).alias("dataset"), form.alias("form")))
    return route(requests, routes, keep=[clinical.KEY])
