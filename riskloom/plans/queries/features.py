"""Projection, filter, feature, split, rounding, verdict and parsing queries."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from riskloom.functions import round_half_even, verdict_code, verdict_colour, verdict_message
from riskloom.operators.prepare import HASHES, assemble, cast_project, hash_split, hash_split_flag, random_split, view_filter
from riskloom.operators.score import parse_requests
from riskloom.plans import fixture as fx
from riskloom.plans.queries.common import read_driver_table
from riskloom.specs import DIABETES, HEART


def cast_project_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-1: text columns (and one the schema does not name) to the schema's
    types; strict on clean text, tolerant where every tenth price is bad."""
    orders = read_driver_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    text = orders.select(
        k.cast("string").alias("o_orderkey"),
        F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.lit("added by the store").alias("_id"),
    )
    spoiled = text.withColumn("o_totalprice", F.when(k % 10 == 0, "n/a").otherwise(F.col("o_totalprice")))
    types = {"o_orderkey": LongType(), "o_totalprice": DoubleType(), "o_custkey": IntegerType()}
    schema = StructType([StructField(n, t) for n, t in types.items()])
    strict = cast_project(text, schema).select(F.lit("strict").alias("mode"), "*")
    return strict.unionByName(cast_project(spoiled, schema, tolerant=True).select(F.lit("tolerant").alias("mode"), "*"))


def sql_view_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-5/P-6: temp view + SELECT * ... WHERE (pushed to the scan)."""
    return view_filter(spark, read_driver_table(spark, sf_dir, "customer"), "riskloom_customer", "c_acctbal < 20")


def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-1/P-2: assemble, then sum each vector position with a vector aggregate."""
    li = read_driver_table(spark, sf_dir, "lineitem")
    vec = assemble(li, fx.FEATURES, keep=[])
    sums = vec.agg(Summarizer.sum(F.col("features")).alias("s"))
    names = F.array(*[F.lit(n) for n in fx.FEATURES])
    exploded = sums.select(F.posexplode(vector_to_array("s")).alias("pos", "total"))
    return exploded.select(
        "pos", F.element_at(names, F.col("pos") + 1).alias("feature"), F.round("total", 4).alias("total")
    )


def assemble_skip_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-1 handleInvalid=skip: rows with a NULL feature are dropped.

    Every order is read; the price of every 7th order is set to NULL to give
    the assembler invalid rows, and exactly those rows must disappear.
    """
    orders = read_driver_table(spark, sf_dir, "orders")
    holed = orders.select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("o_totalprice"))
        .alias("o_totalprice"),
    )
    return assemble(holed, ["o_totalprice", "o_custkey"], handle_invalid="skip", keep=["o_orderkey"]).select(
        "o_orderkey"
    )


def random_split_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-2: a seeded 80/20 split is disjoint and complete.

    Keys are unique, so equal counts and equal sums of key hashes on the two
    sides together and in the source show it without a shuffle by key.
    """
    orders = read_driver_table(spark, sf_dir, "orders").select("o_orderkey")
    tr, te = random_split(orders, [0.8, 0.2], seed=42)
    parts = orders.withColumn("side", F.lit("all")).unionByName(tr.withColumn("side", F.lit("train"))).unionByName(te.withColumn("side", F.lit("test")))
    of = lambda side, c: F.sum(F.when(F.col("side") == side, c))
    one, h = F.lit(1), F.xxhash64("o_orderkey").cast("decimal(38,0)")
    sums = parts.agg(*[of(s, c).alias(f"{n}_{s}") for s in ("all", "train", "test") for n, c in (("n", one), ("h", h))])
    same = (F.col("n_train") + F.col("n_test") == F.col("n_all")) & (F.col("h_train") + F.col("h_test") == F.col("h_all"))
    # within 4 standard deviations of the requested 0.8
    tol = F.lit(4.0) * F.sqrt(F.lit(0.8 * 0.2) / F.col("n_all"))
    share_ok = F.abs(F.col("n_train") / F.col("n_all") - F.lit(0.8)) <= tol
    return sums.select(
        F.col("n_all").alias("total"), (F.col("n_train") + F.col("n_test")).alias("n_split"), same.alias("same_rows"), share_ok.alias("share_ok")
    )


def hash_split_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-3 on keys that are sometimes NULL: no row is lost, by either hash."""
    orders = read_driver_table(spark, sf_dir, "orders")
    keyed = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderkey")).alias("k"))
    sides = [
        side.select(F.lit(method).alias("method"), F.lit(i == 0).alias("is_train"), "o_orderkey")
        for method in HASHES
        for i, side in enumerate(hash_split(keyed, "k", 0.8, method))
    ]
    rows = reduce(DataFrame.unionByName, sides)
    return rows.groupBy("method").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("o_orderkey").alias("key_sum"),
        (F.countDistinct(F.when(F.col("o_orderkey") % 10 == 0, F.col("is_train"))) == 1).alias("nulls_together"),
    )


def hash_split_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-3: reproducible split flag from md5 of the key."""
    orders = read_driver_table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", hash_split_flag("o_orderkey", 0.8).alias("is_train"))


def round_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R-2: half-to-even rounding (0.5 -> 0, 1.5 -> 2, 2.5 -> 2)."""
    li = read_driver_table(spark, sf_dir, "lineitem")
    half = (F.col("l_quantity") / 2).alias("half")
    return li.select("l_orderkey", "l_linenumber", half).select(
        "l_orderkey", "l_linenumber", "half", round_half_even("half").alias("prediction")
    )


def _verdicts(spark: SparkSession, sf_dir: str, spec) -> DataFrame:
    li = read_driver_table(spark, sf_dir, "lineitem")
    pred = (F.col("l_linenumber") % 3).cast("int")
    return li.select("l_orderkey", "l_linenumber", pred.alias("prediction")).select(
        "l_orderkey",
        "l_linenumber",
        "prediction",
        verdict_message("prediction", spec.verdict).alias("message"),
        verdict_code("prediction", spec.verdict).alias("val"),
        verdict_colour("prediction", spec.verdict).alias("colour"),
    )


def verdict_default_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X-3/X-5: 0 -> negative, anything else (1 and 2) -> positive."""
    return _verdicts(spark, sf_dir, DIABETES)


def verdict_default_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X-4/X-5: 1 -> positive, anything else (0 and 2) -> negative."""
    return _verdicts(spark, sf_dir, HEART)


def order_requests(orders: DataFrame) -> DataFrame:
    """Diabetes-shaped text requests derived from orders; some values are bad."""
    k = F.col("o_orderkey")
    s = lambda c: c.cast("string")
    return orders.select(
        "o_orderkey",
        F.when(k % 11 == 0, F.lit("x"))
        .when(k % 13 == 0, F.concat(s(k % 17), F.lit(".5")))
        .otherwise(s(k % 17))
        .alias("Pregnancies"),
        F.when(k % 19 == 0, F.lit("abc")).otherwise(s(F.col("o_totalprice"))).alias("Glucose"),
        s(F.col("o_custkey") % 120).alias("BloodPressure"),
        F.when(k % 23 == 0, F.lit("")).otherwise(s(k % 99)).alias("SkinThickness"),
        s(F.col("o_custkey") % 846).alias("Insulin"),
        s((F.col("o_custkey") % 500) / 10.0).alias("BMI"),
        s(F.col("o_totalprice") / 100000.0).alias("DiabetesPedigreeFunction"),
        s(21 + k % 60).alias("Age"),
    )


def parse_requests_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X-1/X-2 tolerant mode: bad text -> NULL, row flagged ``rejected``."""
    reqs = order_requests(read_driver_table(spark, sf_dir, "orders"))
    return parse_requests(reqs, DIABETES, strict=False, keep=["o_orderkey"])
