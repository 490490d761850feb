from __future__ import annotations

import os

from conftest import SF_SMALL
from riskloom.operators.score import score_requests
from riskloom.plans.queries.serving import lineitem_requests
from riskloom.plans import fixture as fx
from riskloom.streaming import run_scoring_stream


def test_stream_equals_batch_and_is_exactly_once(spark, workdir):
    model = fx.fitted(spark, SF_SMALL, "classifier", fx.STUMP)
    reqs = lineitem_requests(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"))
    src = os.path.join(workdir, "src")
    reqs.repartition(4).write.parquet(src)
    sink, ckpt = os.path.join(workdir, "sink"), os.path.join(workdir, "ckpt")
    keep = ["l_orderkey", "l_linenumber"]
    out = run_scoring_stream(spark, fx.LINEITEM_RISK, model, src, reqs.schema, sink, ckpt, keep=keep)
    batch = score_requests(model, reqs, fx.LINEITEM_RISK, strict=False, keep=keep)
    cols = sorted(batch.columns)
    assert sorted(out.columns) == cols
    assert out.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert batch.select(cols).exceptAll(out.select(cols)).count() == 0
    n = out.count()
    # same checkpoint again: nothing new to process, no duplicate rows
    again = run_scoring_stream(spark, fx.LINEITEM_RISK, model, src, reqs.schema, sink, ckpt, keep=keep)
    assert again.count() == n


def test_stream_in_bounded_batches(spark, workdir):
    from riskloom.streaming import start_scoring_stream

    model = fx.fitted(spark, SF_SMALL, "classifier", fx.STUMP)
    reqs = lineitem_requests(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"))
    src = os.path.join(workdir, "src")
    reqs.repartition(4).write.parquet(src)
    sink = os.path.join(workdir, "sink")
    q = start_scoring_stream(spark, fx.LINEITEM_RISK, model, src, reqs.schema, sink, os.path.join(workdir, "ck"),
                             keep=["l_orderkey", "l_linenumber"], max_files_per_trigger=1)
    q.awaitTermination(300)
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 4  # one file per micro-batch
    assert spark.read.parquet(sink).count() == reqs.count()


def test_running_stream_picks_up_new_files_once(spark, workdir):
    from riskloom.streaming import start_scoring_stream

    model = fx.fitted(spark, SF_SMALL, "classifier", fx.STUMP)
    reqs = lineitem_requests(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"))
    src, sink = os.path.join(workdir, "incoming"), os.path.join(workdir, "sink")
    first, second = reqs.where("l_linenumber <= 3"), reqs.where("l_linenumber > 3")
    first.write.parquet(os.path.join(src, "drop1"))
    q = start_scoring_stream(spark, fx.LINEITEM_RISK, model, os.path.join(src, "*"), reqs.schema, sink,
                             os.path.join(workdir, "ck"), keep=["l_orderkey", "l_linenumber"],
                             available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
        assert spark.read.parquet(sink).count() == first.count()
        second.write.parquet(os.path.join(src, "drop2"))
        q.processAllAvailable()
        assert spark.read.parquet(sink).count() == reqs.count()
    finally:
        q.stop()
