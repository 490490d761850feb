"""A store whose appends differ in fields and types."""

import pytest
from pyspark.sql.types import ArrayType, IntegerType, StructType

from riskloom.sources.documents import append_documents, read_documents, stored_schema

SCHEMA = StructType().add("id", "long").add("n", "integer").add("x", "double").add("name", "string")


@pytest.fixture()
def store(spark, workdir):
    path = f"{workdir}/documents"
    append_documents(spark.createDataFrame([(1, 2, 0.5, "a"), (2, None, None, None)], SCHEMA), path)
    append_documents(spark.createDataFrame([("3", " 7 ", "oops", [1, 2])], "id string, n string, x string, `odd name` array<int>"), path)
    append_documents(spark.createDataFrame([(4, 6.9, 1, {"k": "v"})], "id int, n double, x int, name map<string,string>"), path)
    return path


def test_documents_are_typed_on_read(spark, store):
    rows = read_documents(spark, store, SCHEMA, tolerant=True, rejected="bad").orderBy("id")
    assert rows.drop("bad").schema == SCHEMA
    assert [tuple(r) for r in rows.collect()] == [
        (1, 2, 0.5, "a", False),
        (2, None, None, None, False),
        (3, 7, None, None, True),
        (4, 6, 1.0, '{"k":"v"}', False),
    ]


def test_strict_read_refuses_bad_values(spark, store):
    assert read_documents(spark, store, StructType().add("id", "long").add("gone", "date")).orderBy("id").collect()[3] == (4, None)
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST|CAST_INVALID_INPUT"):
        read_documents(spark, store, SCHEMA).collect()


def test_odd_fields(spark, store, workdir):
    odd = StructType().add("odd name", ArrayType(IntegerType())).add("id", "string")
    assert sorted((r[1], r[0]) for r in read_documents(spark, store, odd).where("id = '3'").collect()) == [("3", [1, 2])]
    with pytest.raises(ValueError):
        read_documents(spark, store, StructType().add("it's", "integer"))
    assert "id: VARIANT" in stored_schema(spark, store).replace("BIGINT", "VARIANT")
    append_documents(spark.createDataFrame([], SCHEMA), f"{workdir}/none")
    assert read_documents(spark, f"{workdir}/none", SCHEMA).count() == 0


def test_only_fields_asked_for_are_read(spark, store):
    plan = read_documents(spark, store, StructType().add("id", "long"), tolerant=True)._jdf.queryExecution().executedPlan().toString()
    assert "doc:struct<0:bigint>" in plan
