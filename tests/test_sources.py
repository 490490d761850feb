"""CSV sources on small invented files (no rows from the reference's data)."""

from __future__ import annotations

import math
import os

import pytest
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from riskloom.sources.csv import read_csv_inferred, read_csv_typed, read_text_csv
from riskloom.specs import DIABETES, HEART

EDGE_SCHEMA = StructType(
    [StructField("A", IntegerType()), StructField("B", DoubleType()), StructField("c", IntegerType())]
)


def _write(path: str, text: str) -> str:
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def test_edge_rows_permissive(spark, workdir):
    p = _write(
        os.path.join(workdir, "edge.csv"),
        "A,B,c\n1,2.5,3\n6.0,148,1\nx,,0\n5,1\n7,8,9,10\n99999999999,NaN,1\n\n",
    )
    rows = [tuple(r) for r in read_csv_typed(spark, p, EDGE_SCHEMA).collect()]
    assert rows[0] == (1, 2.5, 3)
    assert rows[1] == (None, 148.0, 1)  # decimal text in an int column
    assert rows[2] == (None, None, 0)  # text in int, empty cell
    assert rows[3] == (5, 1.0, None)  # short row
    assert rows[4] == (7, 8.0, 9)  # long row: extras dropped
    assert rows[5][0] is None and math.isnan(rows[5][1]) and rows[5][2] == 1
    assert len(rows) == 6  # blank line skipped


def test_corrupt_column_and_modes(spark, workdir):
    p = _write(os.path.join(workdir, "m.csv"), "A,B,c\n1,2.5,3\nx,1.0,2\n")
    df = read_csv_typed(spark, p, EDGE_SCHEMA, corrupt_column="_bad")
    got = [(r.A, r._bad is not None) for r in df.collect()]
    assert got == [(1, False), (None, True)]
    # count() alone skips CSV parsing, so malformed rows are only seen when
    # columns are read
    assert len(read_csv_typed(spark, p, EDGE_SCHEMA, mode="DROPMALFORMED").collect()) == 1
    with pytest.raises(Exception):
        read_csv_typed(spark, p, EDGE_SCHEMA, mode="FAILFAST").collect()
    with pytest.raises(ValueError):
        read_csv_typed(spark, p, EDGE_SCHEMA, mode="LENIENT")


def test_header_binds_by_position(spark, workdir):
    p = _write(os.path.join(workdir, "h.csv"), "B,A,c\n1,2,3\n")
    r = read_csv_typed(spark, p, EDGE_SCHEMA).first()
    assert (r.A, r.B, r.c) == (1, 2.0, 3)
    with pytest.raises(Exception):
        read_csv_typed(spark, p, EDGE_SCHEMA, enforce_header=True).collect()


def test_crlf_and_integer_text_in_double_columns(spark, workdir):
    # clinical schema: whole numbers in double columns, CRLF, unterminated last line
    header = ",".join(f.name for f in DIABETES.schema.fields)
    body = "\r\n".join(["2,120,70,20,0,30.5,0.25,33,1", "0,95,64,0,85,22.1,0.9,41,0"])
    p = _write(os.path.join(workdir, "d.csv"), header + "\r\n" + body)
    rows = read_csv_typed(spark, p, DIABETES.schema).collect()
    assert rows[0].Glucose == 120.0 and rows[0].Pregnancies == 2 and rows[0].diabetes == 1
    assert rows[1].Insulin == 85.0 and rows[1].Age == 41


def test_heart_schema_order_and_types():
    names = [f.name for f in HEART.schema.fields]
    assert names[0] == "age" and names[-1] == "heartdisease" and len(names) == 14
    assert isinstance(HEART.schema["oldpeak"].dataType, DoubleType)
    assert HEART.features == names[:-1]


def test_inferred_and_text(spark, workdir):
    p = _write(os.path.join(workdir, "i.csv"), "A,B,c\n1,2.5,3\n4,5.0,6\n")
    inf = read_csv_inferred(spark, p)
    assert dict(inf.dtypes) == {"A": "int", "B": "double", "c": "int"}
    t = _write(os.path.join(workdir, "t.csv"), "1,2.5,3\nx,4,5\n")
    rows = [tuple(r) for r in read_text_csv(spark, t, EDGE_SCHEMA).collect()]
    assert rows == [(1, 2.5, 3), (None, 4.0, 5)]


def test_timestamp_ntz_round_trip_keeps_microseconds(spark, workdir):
    from conftest import SF_SMALL

    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    out = os.path.join(workdir, "events")
    events.write.option("header", "true").option("timestampNTZFormat", fmt).csv(out)
    back = read_csv_typed(spark, out, events.schema, timestampNTZFormat=fmt)
    assert back.exceptAll(events).count() == 0 and events.exceptAll(back).count() == 0
