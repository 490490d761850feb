from __future__ import annotations

import glob
import os

from pyspark.sql import functions as F

from riskloom.sinks import append_table, display_table, predictions_json, write_predictions_csv
from riskloom.sources.table import read_table


def test_predictions_csv_crlf_header(spark, workdir):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 1)], "prediction int, label int")
    out = os.path.join(workdir, "pred")
    write_predictions_csv(df, out, single_file=True)
    parts = glob.glob(os.path.join(out, "part-*.csv"))
    assert len(parts) == 1
    raw = open(parts[0], "rb").read()
    assert raw.startswith(b"prediction,label\r\n")
    assert raw.count(b"\r\n") == 4 and b"\n" not in raw.replace(b"\r\n", b"")
    # overwrite replaces, never appends
    write_predictions_csv(df.limit(1), out, single_file=True)
    assert spark.read.option("header", "true").csv(out).count() == 1


def test_append_never_dedups(spark, workdir):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    store = os.path.join(workdir, "store")
    append_table(df, store)
    append_table(df, store)
    assert read_table(spark, store).count() == 4


def test_json_and_display(spark):
    df = spark.createDataFrame([(1, 0)], "prediction int, label int")
    assert predictions_json(df).first().json == '{"prediction":1,"label":0}'
    counts = spark.createDataFrame([(0, 0, 5, 1), (1, 1, 7, 2)], "prediction int, label int, n long, r int")
    table = display_table(counts, ["prediction", "label", "n"], ["r"])
    rows = [tuple(r) for r in table.orderBy(F.desc("is_header"), "r").collect()]
    assert rows == [(True, None, "prediction", "label", "n"), (False, 1, "0", "0", "5"), (False, 2, "1", "1", "7")]
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_named_store_table_accumulates(spark, workdir):
    from riskloom.plans.jobs import ingest
    from riskloom.specs import DatasetSpec, HEART

    spec = DatasetSpec("heart_named", HEART.schema, HEART.label, "riskloom_heart_store", HEART.verdict)
    rows = [(50, 1, 2, 120, 200, 0, 1, 150, 0, 1.5, 2, 0, 3, 1), (41, 0, 1, 110, 180, 0, 0, 170, 0, 0.0, 1, 0, 2, 0)]
    df = spark.createDataFrame(rows, HEART.schema).withColumn("_id", F.monotonically_increasing_id())
    spark.sql(f"DROP TABLE IF EXISTS {spec.table}")
    assert ingest(spark, spec, df).count() == 2
    out = ingest(spark, spec, df)
    assert out.count() == 4
    assert out.columns == [f.name for f in HEART.schema.fields]  # store-added column dropped


def test_predictions_json_files(spark, workdir):
    from riskloom.sinks import write_predictions_json

    df = spark.createDataFrame([(1, 0), (0, 0)], "prediction int, label int")
    out = os.path.join(workdir, "json")
    write_predictions_json(df, out)
    back = spark.read.schema("prediction int, label int").json(out)
    assert sorted(map(tuple, back.collect())) == [(0, 0), (1, 0)]
