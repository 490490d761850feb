"""The command line runs the ingest -> train -> score -> stream flow."""

from __future__ import annotations

import json
import os

import pytest

from riskloom.__main__ import main
from test_score import _invented_diabetes_csv


def test_cli_flow(spark, workdir, capsys):
    csv = _invented_diabetes_csv(os.path.join(workdir, "d.csv"), n=300, seed=11)
    store, model = os.path.join(workdir, "store"), os.path.join(workdir, "model")
    assert main(["ingest", "--dataset", "diabetes", "--csv", csv, "--store", store]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"store_rows": 300}
    assert main(["train", "--dataset", "diabetes", "--store", store, "--model", model,
                 "--predictions", os.path.join(workdir, "pred")]) == 0
    metrics = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert metrics["n_test"] == metrics["tn"] + metrics["fp"] + metrics["fn"] + metrics["tp"]
    with pytest.raises(Exception):  # the model exists: a second batch run fails without --overwrite
        main(["train", "--dataset", "diabetes", "--store", store, "--model", model])
    assert main(["train", "--dataset", "diabetes", "--store", store, "--model", model, "--overwrite"]) == 0
    req_dir = os.path.join(workdir, "requests")
    os.makedirs(req_dir)
    with open(os.path.join(req_dir, "r1.csv"), "w") as f:
        f.write("Pregnancies,Glucose,BloodPressure,SkinThickness,Insulin,BMI,DiabetesPedigreeFunction,Age\n")
        f.write("1,190,70,20,0,30.1,0.5,30\n2,90,70,20,0,22.0,0.3,25\nx,90,70,20,0,22.0,0.3,25\n")
    out = os.path.join(workdir, "scored")
    assert main(["score", "--dataset", "diabetes", "--requests", req_dir, "--model", model, "--out", out]) == 0
    rows = spark.read.parquet(out).collect()
    assert sorted(r.rejected for r in rows) == [False, False, True]
    keyed = os.path.join(workdir, "keyed")
    os.makedirs(keyed)
    with open(os.path.join(keyed, "r.csv"), "w") as f:
        f.write("rid,Pregnancies,Glucose,BloodPressure,SkinThickness,Insulin,BMI,DiabetesPedigreeFunction,Age\n")
        f.write("a1,1,190,70,20,0,30.1,0.5,30\nb2,x,90,70,20,0,22.0,0.3,25\n")
    out2 = os.path.join(workdir, "scored2")
    assert main(["score", "--dataset", "diabetes", "--requests", keyed, "--model", model, "--out", out2,
                 "--keep", "rid"]) == 0
    got = {r.rid: r.rejected for r in spark.read.parquet(out2).collect()}
    assert got == {"a1": False, "b2": True}
    capsys.readouterr()
    assert main(["score-one", "--dataset", "diabetes", "--model", model, "--values", "1,190,70,20,0,30.1,0.5,30"]) == 0
    verdict = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert verdict == {"prediction": 1, "message": "person is diabetic", "val": "1", "colour": "red"}
    sink = os.path.join(workdir, "sink")
    assert main(["stream", "--dataset", "diabetes", "--source", req_dir, "--model", model, "--sink", sink,
                 "--checkpoint", os.path.join(workdir, "ckpt")]) == 0
    assert spark.read.parquet(sink).count() == 3


def test_cli_train_regressor_writes_raw_scores(spark, workdir, capsys):
    csv = _invented_diabetes_csv(os.path.join(workdir, "d.csv"), n=300, seed=5, noise=0.2)
    store = os.path.join(workdir, "store")
    main(["ingest", "--dataset", "diabetes", "--csv", csv, "--store", store])
    pred = os.path.join(workdir, "pred")
    assert main(["train", "--dataset", "diabetes", "--store", store, "--model", os.path.join(workdir, "m"),
                 "--predictions", pred, "--kind", "regressor"]) == 0
    vals = {float(r.prediction) for r in spark.read.option("header", "true").csv(pred).collect()}
    assert any(v not in (0.0, 1.0) for v in vals)  # raw leaf means, not rounded


def test_cli_ingest_infer_schema(spark, workdir, capsys):
    csv = _invented_diabetes_csv(os.path.join(workdir, "d.csv"), n=40, seed=2)
    store = os.path.join(workdir, "store")
    assert main(["ingest", "--dataset", "diabetes", "--csv", csv, "--store", store, "--infer-schema"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"store_rows": 40}
    from riskloom.specs import DIABETES

    stored = spark.read.parquet(store)
    assert [f.name for f in stored.schema.fields] == [f.name for f in DIABETES.schema.fields]
