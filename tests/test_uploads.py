"""Uploads as a stream: each file once, whatever fails in between."""

import glob
import os
import shutil
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException

from riskloom.specs import DIABETES
from riskloom.streaming import uploads
from riskloom.streaming.uploads import commit_batch, ingest_uploads, ledger, read_uploads

HEADER = ",".join(DIABETES.schema.names)


def upload(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w", newline="") as f:
        f.write("\r\n".join([HEADER, *lines]))


def line(n, label="1"):
    return f"{n},100.5,70,20,80,30.1,0.5,40,{label}"


@pytest.fixture()
def places(workdir):
    return [f"{workdir}/{x}" for x in ("source", "store", "checkpoint")]


def numbers(df):
    return Counter(r[0] for r in df.select("Pregnancies").collect())


def test_no_upload_is_an_empty_store(spark, places):
    assert read_uploads(spark, places[1], DIABETES.schema).collect() == [] and ledger(spark, places[1]).count() == 0


def test_files_arrive_once_and_are_counted(spark, places):
    source, store, _ = places
    upload(source, "a", line(1), line(2, ""))
    upload(source, "b", line(3), "4,not a number,70,20,80,30.1,0.5,40,0")
    rows = ingest_uploads(spark, DIABETES, *places, max_files_per_trigger=1)
    assert rows.schema == DIABETES.schema and numbers(rows) == {1: 1, 2: 1, 3: 1, 4: 1}
    assert rows.where("Glucose is null").count() == 1
    upload(source, "c", line(1))  # another file's copy of a row is another row
    assert numbers(ingest_uploads(spark, DIABETES, *places)) == {1: 2, 2: 1, 3: 1, 4: 1}
    batches = ledger(spark, store).collect()
    assert len(batches) == 3 and len({b["stream"] for b in batches}) == 1 and all(b["stream"] for b in batches)
    assert [sum(b[x] for b in batches) for x in ("n_rows", "n_malformed", "n_null_label")] == [5, 1, 1]


def test_a_batch_replayed_after_its_commit_adds_nothing(spark, places):
    source, store, checkpoint = places
    upload(source, "a", line(1))
    ingest_uploads(spark, DIABETES, *places)
    upload(source, "b", line(2))
    ingest_uploads(spark, DIABETES, *places)
    last = max(int(os.path.basename(p)) for p in glob.glob(f"{checkpoint}/commits/[0-9]*"))
    uncommitted = f"{checkpoint}-died"  # as if the driver had died before it noted the batch's end
    shutil.copytree(checkpoint, uncommitted, ignore=lambda at, names: [n for n in names if at.endswith("commits") and n.strip(".").split(".")[0] == str(last)])
    assert numbers(ingest_uploads(spark, DIABETES, source, store, uncommitted)) == {1: 1, 2: 1} and ledger(spark, store).count() == 2


def test_a_batch_that_fails_before_its_commit_is_hidden_then_replaced(spark, places, monkeypatch):
    source, store, _ = places
    upload(source, "a", line(1))
    ingest_uploads(spark, DIABETES, *places)
    upload(source, "b", line(2))

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(uploads, "LEDGER", uploads.LEDGER.replace("n_rows", "other"))  # the row cannot be written
        m.setattr(spark.__class__, "createDataFrame", fails)
        with pytest.raises(StreamingQueryException):
            ingest_uploads(spark, DIABETES, *places)
    assert numbers(read_uploads(spark, store, DIABETES.schema)) == {1: 1}
    assert numbers(ingest_uploads(spark, DIABETES, *places)) == {1: 1, 2: 1}


def test_a_fresh_stream_appends_again(spark, places):
    source, store, checkpoint = places
    upload(source, "a", line(1))
    ingest_uploads(spark, DIABETES, *places)
    assert numbers(ingest_uploads(spark, DIABETES, source, store, f"{checkpoint}-2")) == {1: 2}
    rows = read_uploads(spark, store, DIABETES.schema)
    assert commit_batch(rows, "by hand", 0, f"{store}-2", "diabetes") and not commit_batch(rows, "by hand", 0, f"{store}-2", "diabetes")
