"""Command line: ``python -m riskloom <command> ...``.

    ingest  --dataset D --csv PATH [--store PATH]
    train   --dataset D [--store PATH] --model PATH --predictions PATH [--kind K]
    score   --dataset D --requests CSV --model PATH --out PATH [--strict] [--keep COLS]
    score-one --dataset D --model PATH --values v1,v2,...
    stream  --dataset D --source DIR --model PATH --sink DIR --checkpoint DIR

The session comes from the environment (``spark-submit`` / cluster config);
only bounded results (one metrics row) are printed.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from riskloom.operators.model import load_model
from riskloom.operators.score import score_typed
from riskloom.plans.jobs import SPLITS, ingest, score, train
from riskloom.sources.csv import header_schema, read_csv_named
from riskloom.sources.table import parse_form, read_table, request_frame
from riskloom.specs import TreeParams, select_job
from riskloom.streaming import start_scoring_stream


def _keep(arg: str | None) -> list[str]:
    return [c for c in (arg or "").split(",") if c]


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="riskloom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("ingest", "train", "score", "score-one", "stream"):
        p = sub.add_parser(name)
        p.add_argument("--dataset", required=True)
        p.add_argument("--format", default="parquet", help="store format")
    sub.choices["ingest"].add_argument("--csv", required=True)
    sub.choices["ingest"].add_argument("--infer-schema", action="store_true", help="infer CSV types, then cast")
    sub.choices["ingest"].add_argument("--store", help="store path; default: the dataset's catalog table")
    t = sub.choices["train"]
    t.add_argument("--store", help="store path; default: the dataset's catalog table")
    t.add_argument("--model", required=True)
    t.add_argument("--predictions")
    t.add_argument("--kind", choices=("classifier", "regressor"))
    t.add_argument("--split-key", help="comma-separated; default: all schema columns")
    t.add_argument("--max-depth", type=int, default=5)
    t.add_argument("--max-bins", type=int, default=32)
    t.add_argument("--seed", type=int, default=42)
    t.add_argument("--train-fraction", type=float, default=0.8)
    t.add_argument("--split", choices=SPLITS, default="hash")
    t.add_argument("--split-hash", choices=("md5", "xxhash64"), default="md5")
    t.add_argument("--overwrite", action="store_true", help="replace an existing model instead of failing")
    s = sub.choices["score"]
    s.add_argument("--requests", required=True, help="CSV with header, one column per feature")
    s.add_argument("--model", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--strict", action="store_true")
    s.add_argument("--keep", help="comma-separated id columns that are carried through")
    one = sub.choices["score-one"]
    one.add_argument("--model", required=True)
    one.add_argument("--values", required=True, help="comma-separated form values in the schema's feature order")
    st = sub.choices["stream"]
    st.add_argument("--source", required=True)
    st.add_argument("--model", required=True)
    st.add_argument("--sink", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--processing-time", help="e.g. '10 seconds'; default: process what is available and stop")
    st.add_argument("--keep", help="comma-separated id columns that are carried through")
    st.add_argument("--max-files-per-trigger", type=int)
    a = ap.parse_args(argv)

    action = "train" if a.cmd in ("ingest", "train") else "score"
    spec, _ = select_job(a.dataset, action)
    spark = SparkSession.builder.appName(f"riskloom-{a.cmd}").getOrCreate()

    if a.cmd == "ingest":
        n = ingest(spark, spec, a.csv, a.store, a.format, infer_schema=a.infer_schema).count()
        print(json.dumps({"store_rows": n}))
    elif a.cmd == "train":
        data = read_table(spark, a.store, a.format, table=None if a.store else spec.table)
        key = a.split_key.split(",") if a.split_key else [f.name for f in spec.schema.fields]
        params = TreeParams(max_depth=a.max_depth, max_bins=a.max_bins, seed=a.seed)
        res = train(spark, spec, data, key, a.model, a.predictions, kind=a.kind, params=params,
                    train_fraction=a.train_fraction, split_hash=a.split_hash, split=a.split, seed=a.seed,
                    overwrite=a.overwrite)
        print(json.dumps(res.metrics.first().asDict()))
    elif a.cmd == "score":
        keep = _keep(a.keep)
        reqs = read_csv_named(spark, a.requests, [*keep, *spec.features])
        score(spark, spec, reqs, a.model, strict=a.strict, keep=keep).write.mode("overwrite").parquet(a.out)
    elif a.cmd == "score-one":
        # the single-user form: values parsed like the form handler (a bad value raises)
        values = parse_form(spec, a.values.split(","))
        model = load_model(spark, a.model)
        row = score_typed(model, request_frame(spark, spec, [values]), spec).first()
        print(json.dumps({"prediction": row.prediction, "message": row.message, "val": row.val,
                          "colour": row.colour}))
    else:
        model = load_model(spark, a.model)
        keep = _keep(a.keep)
        q = start_scoring_stream(
            spark, spec, model, a.source, header_schema(spark, a.source, [*keep, *spec.features]), a.sink, a.checkpoint, keep=keep,
            available_now=a.processing_time is None, processing_time=a.processing_time, fmt="csv",
            max_files_per_trigger=a.max_files_per_trigger,
        )
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
