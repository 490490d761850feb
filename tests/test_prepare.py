from __future__ import annotations

import pytest
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from conftest import SF_SMALL
from riskloom.operators.prepare import (
    assemble,
    cast_project,
    hash_split,
    hash_split_flag,
    hash_threshold,
    random_split,
    view_filter,
)


def test_cast_project_drops_and_casts(spark):
    df = spark.createDataFrame([("1", "2.5", "extra", "id-1")], ["a", "b", "c", "_id"])
    schema = StructType([StructField("a", IntegerType()), StructField("b", DoubleType())])
    out = cast_project(df, schema)
    assert out.columns == ["a", "b"]
    assert tuple(out.first()) == (1, 2.5)
    bad = spark.createDataFrame([("x", "2.5")], ["a", "b"])
    assert tuple(cast_project(bad, schema, tolerant=True).first()) == (None, 2.5)


def test_view_filter_is_pushed_to_scan(spark):
    cust = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    out = view_filter(spark, cust, "t_customer", "c_acctbal < 20")
    assert out.count() == 11
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(c_acctbal,20" in plan


def test_assemble_invalid_modes(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (float("nan"), 3.0)], "x double, y double")
    assert assemble(df, ["x", "y"], handle_invalid="skip").count() == 1
    kept = assemble(df, ["x", "y"], handle_invalid="keep").count()
    assert kept == 3
    with pytest.raises(Exception):
        assemble(df, ["x", "y"], handle_invalid="error").collect()


def test_hash_split_deterministic_disjoint_complete(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    tr, te = hash_split(orders, "o_orderkey", 0.8)
    n, a, b = orders.count(), tr.count(), te.count()
    assert a + b == n
    assert tr.join(te, "o_orderkey", "left_semi").count() == 0
    # the same flag again after a reshuffle
    again = orders.repartition(5).where(hash_split_flag("o_orderkey", 0.8)).count()
    assert again == a
    assert hash_threshold(0.8) == "cccc"


def test_random_split_seeded(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    tr, te = random_split(orders, [0.8, 0.2], seed=7)
    tr2, _ = random_split(orders, [0.8, 0.2], seed=7)
    assert tr.count() + te.count() == orders.count()
    assert sorted(r[0] for r in tr.collect()) == sorted(r[0] for r in tr2.collect())
    assert tr.join(te, "o_orderkey", "left_semi").count() == 0


def test_hash_split_keeps_rows_with_null_keys(spark):
    from pyspark.sql import functions as F

    df = spark.range(100).select("id", F.when(F.col("id") % 10 != 0, F.col("id")).alias("k"), F.lit(None).cast("string").alias("z"))
    for method in ("md5", "xxhash64"):
        for key in ("k", "z", ["k", "z"]):
            tr, te = hash_split(df, key, 0.8, method)
            assert sorted(r.id for r in tr.union(te).collect()) == list(range(100)), (method, key)


def test_xxhash_split_is_deterministic_and_near_fraction(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    tr, te = hash_split(orders, "o_orderkey", 0.8, method="xxhash64")
    n, a = orders.count(), tr.count()
    assert a + te.count() == n and abs(a / n - 0.8) < 0.05
    again = orders.repartition(3).where(hash_split_flag("o_orderkey", 0.8, "xxhash64")).count()
    assert again == a
    with pytest.raises(ValueError):
        hash_split_flag("o_orderkey", 0.8, "sha1")


def test_view_filter_equals_dataframe_where(spark):
    from pyspark.sql import functions as F

    cust = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    via_sql = view_filter(spark, cust, "t_customer2", "c_acctbal < 20")
    via_df = cust.where(F.col("c_acctbal") < F.lit(20))
    assert sorted(map(tuple, via_sql.collect())) == sorted(map(tuple, via_df.collect()))
    pushed = [p for p in (via_sql, via_df)
              if "LessThan(c_acctbal,20" in p._jdf.queryExecution().executedPlan().toString()]
    assert len(pushed) == 2
