"""Clinical datasets end to end on invented CSV files, plus scoring edges."""

from __future__ import annotations

import glob
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators.model import compiled_prediction, fit_tree
from riskloom.operators.prepare import assemble
from riskloom.operators.score import parse_requests, score_requests, score_routed, score_typed
from riskloom.plans.jobs import ingest, score, train
from riskloom.sources.table import request_frame
from riskloom.specs import DIABETES, HEART, TreeParams, select_job


def _invented_diabetes_csv(path: str, n: int = 400, seed: int = 3, noise: float = 0.0) -> str:
    rng = np.random.default_rng(seed)
    preg = rng.integers(0, 15, n)
    glucose = rng.integers(60, 200, n)
    bp = rng.integers(40, 110, n)
    skin = rng.integers(0, 60, n)
    insulin = rng.integers(0, 400, n)
    bmi = np.round(rng.uniform(18, 50, n), 1)
    dpf = np.round(rng.uniform(0.05, 2.0, n), 3)
    age = rng.integers(21, 80, n)
    y = ((glucose > 140) | ((bmi > 35) & (age > 45))).astype(int)
    y = np.where(rng.uniform(size=n) < noise, 1 - y, y)
    header = ",".join(f.name for f in DIABETES.schema.fields)
    lines = [header] + [
        f"{preg[i]},{glucose[i]},{bp[i]},{skin[i]},{insulin[i]},{bmi[i]},{dpf[i]},{age[i]},{y[i]}" for i in range(n)
    ]
    with open(path, "w", newline="") as f:
        f.write("\r\n".join(lines))  # CRLF, last line unterminated
    return path


def test_diabetes_ingest_train_score(spark, workdir):
    csv = _invented_diabetes_csv(os.path.join(workdir, "diabetes.csv"))
    store = os.path.join(workdir, "store")
    first = ingest(spark, DIABETES, csv, store)
    assert first.count() == 400
    data = ingest(spark, DIABETES, csv, store)  # a second upload appends again
    assert data.count() == 800
    data = data.withColumn("rid", F.monotonically_increasing_id())
    res = train(
        spark,
        DIABETES,
        data,
        split_key=[f.name for f in DIABETES.schema.fields],  # copies land on one side
        model_path=os.path.join(workdir, "model"),
        predictions_path=os.path.join(workdir, "pred"),
        params=TreeParams(max_depth=5, max_bins=32, seed=1),
    )
    m = res.metrics.first()
    assert m.n_test == m.tn + m.fp + m.fn + m.tp > 0
    assert m.accuracy_percent == math.ceil(m.n_correct / m.n_test * 100)
    assert m.accuracy > 0.8
    parts = glob.glob(os.path.join(workdir, "pred", "part-*.csv"))
    body = b"".join(open(p, "rb").read() for p in parts)
    assert body.startswith(b"prediction,label\r\n") or b"prediction,label\r\n" in body
    # score text requests with the saved model (loader reads its class)
    reqs = spark.createDataFrame(
        [("1", "190", "70", "20", "0", "30.1", "0.5", "30"), ("2", "90", "70", "20", "0", "22.0", "0.3", "25")],
        [f.name for f in DIABETES.feature_schema.fields],
    )
    out = score(spark, DIABETES, reqs, os.path.join(workdir, "model")).collect()
    assert [r.message for r in out] == ["person is diabetic", "person is not diabetic"]
    assert [(r.val, r.colour) for r in out] == [("1", "red"), ("0", "green")]


def test_ingest_with_inferred_types(spark, workdir):
    csv = _invented_diabetes_csv(os.path.join(workdir, "d.csv"), n=50, seed=9)
    typed = ingest(spark, DIABETES, csv, os.path.join(workdir, "s1")).collect()
    inferred = ingest(spark, DIABETES, csv, os.path.join(workdir, "s2"), infer_schema=True)
    assert inferred.schema == DIABETES.schema  # whole numbers inferred as int, cast back to double
    assert sorted(map(tuple, inferred.collect())) == sorted(map(tuple, typed))


def test_heart_single_record_path(spark):
    rows = [(50 + i % 20, i % 2, 1 + i % 4, 120, 200 + i, i % 2, i % 3, 150, i % 2, (i % 30) / 10.0, 1 + i % 3,
             i % 4, 1 + i % 3, int(i % 4 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, HEART.schema)
    from riskloom.operators.model import fit_tree
    from riskloom.operators.prepare import assemble

    model = fit_tree(assemble(df, HEART.features, keep=[HEART.label]), "classifier", HEART.label, TreeParams())
    one = request_frame(spark, HEART, [(52, 0, 1, 120, 201, 0, 1, 150, 0, 0.1, 2, 0, 2)])
    assert one.first().heartdisease == 0  # placeholder label
    out = score_typed(model, one, HEART).first()
    assert out.prediction in (0, 1)
    assert out.message == ("person is having heart disease" if out.prediction == 1 else "person is not having heart disease")


def test_tolerant_scoring_keeps_rejected_rows(spark):
    from riskloom.operators.model import fit_tree
    from riskloom.operators.prepare import assemble
    from riskloom.plans.fixture import LINEITEM_RISK

    train_df = spark.createDataFrame([(float(q), 0.05, 0.02, int(q > 17)) for q in range(1, 51)], LINEITEM_RISK.schema)
    model = fit_tree(assemble(train_df, LINEITEM_RISK.features, keep=["risk"]), "classifier", "risk", TreeParams())
    reqs = spark.createDataFrame([(1, "30", "0.1", "0.0"), (2, "abc", "0.1", "0.0"), (3, "3", None, "0.0")],
                                 "id int, l_quantity string, l_discount string, l_tax string")
    out = {r.id: r for r in score_requests(model, reqs, LINEITEM_RISK, strict=False, keep=["id"]).collect()}
    assert out[1].prediction == 1 and not out[1].rejected and out[1].message == "person is diabetic"
    assert out[2].rejected and out[2].prediction is None and out[2].message is None
    assert out[3].rejected and out[3].prediction is None
    with pytest.raises(Exception):
        score_requests(model, reqs, LINEITEM_RISK, strict=True, keep=["id"]).collect()


def test_parse_requests_flags(spark):
    reqs = spark.createDataFrame([("1", "2", "3", "4", "5", "6", "0.5", "30"), ("1.5", "2", "3", "4", "5", "6", "x", "30")],
                                 [f.name for f in DIABETES.feature_schema.fields])
    rows = parse_requests(reqs, DIABETES, strict=False).collect()
    assert [r.rejected for r in rows] == [False, True]
    assert rows[1].Pregnancies is None and rows[1].DiabetesPedigreeFunction is None


def test_select_job():
    assert select_job("diabetes", "train")[0] is DIABETES
    assert select_job("heart", "score")[0] is HEART
    with pytest.raises(KeyError):
        select_job("Diabetes", "train")
    with pytest.raises(ValueError):
        select_job("heart", "predict")


def test_nan_requests_are_rejected(spark):
    names = [f.name for f in DIABETES.feature_schema.fields]
    reqs = spark.createDataFrame([("1", t, "3", "4", "5", "6", "0.5", "30") for t in ("NaN", "nan", "2")], names)
    assert [r.rejected for r in parse_requests(reqs, DIABETES, strict=False).collect()] == [True, True, False]


def test_model_of_another_dataset_is_refused(spark):
    from riskloom.operators.model import fit_tree
    from riskloom.operators.prepare import assemble

    rows = spark.createDataFrame([(float(i), i % 2) for i in range(10)], "x double, y int")
    model = fit_tree(assemble(rows, ["x"], keep=["y"]), "classifier", "y")
    with pytest.raises(ValueError):
        score_typed(model, request_frame(spark, HEART, [(52, 0, 1, 120, 201, 0, 1, 150, 0, 0.1, 2, 0, 2)]), HEART)


def test_request_csv_binds_by_name(spark, workdir):
    from riskloom.sources.csv import read_csv_named

    folder = os.path.join(workdir, "r")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("b,extra,a\n2,x,1\n")
    assert [tuple(r) for r in read_csv_named(spark, folder, ["a", "b"]).collect()] == [("1", "2")]
    with pytest.raises(ValueError):
        read_csv_named(spark, folder, ["a", "c"])
    with open(os.path.join(folder, "b.csv"), "w") as f:
        f.write("a,extra,b\n3,x,4\n")  # another order than the first file's: refused, not misread
    with pytest.raises(Exception):
        read_csv_named(spark, folder, ["a", "b"]).collect()


def test_train_random_split_keep_columns_and_string_store(spark, workdir):
    csv = _invented_diabetes_csv(os.path.join(workdir, "d.csv"), n=300, seed=4)
    text = spark.read.option("header", "true").csv(csv).withColumn("rid", F.monotonically_increasing_id())
    res = train(spark, DIABETES, text, split="random", seed=7, keep=["rid"], predictions_path=os.path.join(workdir, "p"))
    again = train(spark, DIABETES, text, split="random", seed=7, keep=["rid"])
    assert res.predictions.columns == ["rid", "prediction", "label"]
    rows = sorted(map(tuple, res.predictions.collect()))
    assert rows == sorted(map(tuple, again.predictions.collect())) and 20 < len(rows) < 120
    with pytest.raises(ValueError):
        train(spark, DIABETES, text, split="other")


def test_metrics_count_labelled_rows_only(spark):
    from riskloom.plans.jobs import metrics_frame

    df = spark.createDataFrame([(1.0, 1), (0.0, 1), (1.0, None), (0.0, None)], "prediction double, label int")
    m = metrics_frame(df, "label").first()
    assert (m.n_test, m.n_null_label, m.n_correct, m.accuracy) == (2, 2, 1, 0.5)
    assert m.tn + m.fp + m.fn + m.tp == m.n_test


@pytest.mark.parametrize("kind", ["classifier", "regressor"])
def test_compiled_tree_equals_transform(spark, kind):
    rng = np.random.default_rng(7)
    rows = [(float(a), float(b), int(c), int(a * 3 + b > 2 or c == 3)) for a, b, c in zip(rng.normal(size=600), rng.normal(size=600), rng.integers(0, 5, 600), strict=True)]
    df = spark.createDataFrame(rows, "a double, b double, c int, y int")
    model = fit_tree(assemble(df, ["a", "b", "c"], keep=["y"]), kind, "y", TreeParams(max_depth=6))
    odd = [(float("nan"), 0.0, 1), (float("inf"), float("-inf"), 3), (None, 0.5, None), (-0.0, 0.0, 0)]
    asked = df.select("a", "b", "c").unionByName(spark.createDataFrame(odd, "a double, b double, c int"))
    scored = model.transform(assemble(asked, ["a", "b", "c"], handle_invalid="keep", keep=["a", "b", "c"]))
    both = scored.select("prediction", compiled_prediction(model, ["a", "b", "c"]).alias("compiled"))
    assert both.count() == 604 and both.where("not (prediction <=> compiled)").isEmpty()
    plan = asked.select(compiled_prediction(model, ["a", "b", "c"]))._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan
    with pytest.raises(ValueError, match="features"):
        compiled_prediction(model, ["a", "b"])


def test_routed_requests(spark):
    def tree(spec, split):
        vec = assemble(spark.createDataFrame([tuple([v] * len(spec.features) + [int(v > split)]) for v in range(10)], ", ".join(f"`f{i}` int" for i in range(len(spec.features))) + ", y int"), [f"f{i}" for i in range(len(spec.features))], keep=["y"])
        return fit_tree(vec, "classifier", "y")

    routes = {"diabetes": (DIABETES, tree(DIABETES, 3)), "heart": (HEART, tree(HEART, 6))}
    full = lambda spec, v: {f: str(v) for f in spec.features}
    rows = [
        (1, "diabetes", full(DIABETES, 5)),
        (2, "heart", full(HEART, 5)),
        (3, "heart", full(HEART, 8)),
        (4, "heart", full(DIABETES, 8)),  # the other dataset's fields
        (5, "liver", full(HEART, 8)),
        (6, None, full(HEART, 8)),
        (7, "diabetes", None),
        (8, "diabetes", full(DIABETES, 5) | {"Age": "old"}),
        (9, "diabetes", full(DIABETES, 5) | {"BMI": "NaN"}),
    ]
    out = {r.id: r for r in score_routed(spark.createDataFrame(rows, "id int, dataset string, form map<string,string>"), routes, keep=["id"]).collect()}
    assert {i: r.prediction for i, r in out.items()} == {1: 1, 2: 0, 3: 1} | dict.fromkeys(range(4, 10))
    assert all(r.rejected == (i > 3) and (r.message is None) == (r.val is None) == (r.colour is None) == r.rejected for i, r in out.items())
    assert out[1].message == DIABETES.verdict.positive_message and out[2].message == HEART.verdict.negative_message and out[3].colour == "red"
