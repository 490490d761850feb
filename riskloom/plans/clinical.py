"""Clinical-shaped training tables derived from the driver's ``orders``.

The reference trains on two clinical schemas (diabetes: 8 features, heart:
13). These functions derive rows of exactly those schemas from every order,
using integer arithmetic on the keys, so that each feature has at most 32
distinct values. Under the learner's default 32 bins every candidate split is
then a midpoint between neighbouring values, and the trained trees can be
reproduced exactly in SQL. The labels are deterministic rules over the
features with every 13th (diabetes) or 11th (heart) order flipped as noise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "o_orderkey"


def _flip(rule: Column, every: int) -> Column:
    base = rule.cast("int")
    return F.when(F.col(KEY) % every == 0, F.lit(1) - base).otherwise(base)


def diabetes_rows(orders: DataFrame) -> DataFrame:
    """o_orderkey + the diabetes schema (Pregnancies ... Age, diabetes)."""
    k, c = F.col(KEY), F.col("o_custkey")
    feats = orders.select(
        KEY,
        (k % 17).cast("int").alias("Pregnancies"),
        (F.lit(60.0) + (c % 30) * 5).cast("double").alias("Glucose"),
        (F.lit(40.0) + ((k * 3) % 25) * 3).cast("double").alias("BloodPressure"),
        (((k * 7 + c) % 20) * 3).cast("double").alias("SkinThickness"),
        (((c * 11) % 31) * 10).cast("double").alias("Insulin"),
        (F.lit(18.0) + ((k * 5 + c * 3) % 32) / 2.0).alias("BMI"),
        (((c * 13 + k) % 29) / 20.0).alias("DiabetesPedigreeFunction"),
        (F.lit(21) + (k * 11 + c * 7) % 30).cast("int").alias("Age"),
    )
    rule = (
        (F.col("Glucose") >= 150)
        | ((F.col("BMI") >= 28) & (F.col("Age") >= 35))
        | ((F.col("Pregnancies") >= 12) & (F.col("Insulin") >= 200))
    )
    return feats.withColumn("diabetes", _flip(rule, 13))


def heart_rows(orders: DataFrame) -> DataFrame:
    """o_orderkey + the heart schema (age ... thal, heartdisease)."""
    k, c = F.col(KEY), F.col("o_custkey")
    feats = orders.select(
        KEY,
        (F.lit(29) + (k * 3) % 31).cast("int").alias("age"),
        (c % 2).cast("int").alias("sex"),
        (F.lit(1) + k % 4).cast("int").alias("cp"),
        (F.lit(94) + (c % 30) * 3).cast("int").alias("trestbps"),
        (F.lit(126) + ((k * 7) % 32) * 10).cast("int").alias("chol"),
        (k % 7 == 0).cast("int").alias("fbs"),
        (c % 3).cast("int").alias("restecg"),
        (F.lit(71) + ((k * 5 + c) % 31) * 4).cast("int").alias("thalach"),
        ((k + c) % 2).cast("int").alias("exang"),
        (((k * 13) % 31) / 5.0).alias("oldpeak"),
        (F.lit(1) + (k + c) % 3).cast("int").alias("slope"),
        ((k * 3 + c) % 4).cast("int").alias("ca"),
        (F.lit(1) + (k * 11) % 3).cast("int").alias("thal"),
    )
    rule = (
        ((F.col("cp") >= 3) & (F.col("thalach") < 150))
        | ((F.col("oldpeak") >= 3.0) & (F.col("exang") == 1))
        | ((F.col("ca") >= 2) & (F.col("age") >= 50))
    )
    return feats.withColumn("heartdisease", _flip(rule, 11))


def text_requests(rows: DataFrame, spec) -> DataFrame:
    """The feature columns as form-like text, keyed by order."""
    return rows.select(KEY, *[F.col(c).cast("string").alias(c) for c in spec.features])


# Form submissions for the single-record path: (request id, form values as
# text, in the schema's feature order).
DIABETES_FORMS = [
    (1, ("2", "160", "70", "20", "100", "25.5", "0.45", "30")),
    (2, ("1", "95", "64", "12", "0", "21", "0.3", "25")),
    (3, ("13", "110", "80", "30", "250", "24", "1.1", "41")),
    (4, ("4", "120", "88", "40", "90", "31.5", "0.2", "52")),
]
HEART_FORMS = [
    (1, ("58", "1", "4", "140", "250", "0", "1", "130", "0", "1.2", "2", "0", "2")),
    (2, ("44", "0", "2", "120", "210", "0", "0", "175", "0", "0.4", "1", "0", "3")),
    (3, ("61", "1", "1", "132", "300", "1", "2", "160", "1", "3.4", "3", "2", "1")),
    (4, ("52", "0", "3", "115", "190", "0", "1", "120", "1", "2.6", "2", "3", "2")),
]


# The same derivations in SQL, for the oracles.
DIABETES_SQL = """
SELECT o_orderkey, Pregnancies, Glucose, BloodPressure, SkinThickness, Insulin, BMI,
       DiabetesPedigreeFunction, Age,
       CASE WHEN o_orderkey % 13 = 0 THEN 1 - r ELSE r END AS risk,
       substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 4) < 'cccc' AS is_train
FROM (
  SELECT *, CAST(Glucose >= 150 OR (BMI >= 28 AND Age >= 35) OR (Pregnancies >= 12 AND Insulin >= 200) AS INTEGER) AS r
  FROM (
    SELECT o_orderkey,
           CAST(o_orderkey % 17 AS INTEGER) AS Pregnancies,
           CAST(60 + (o_custkey % 30) * 5 AS DOUBLE) AS Glucose,
           CAST(40 + ((o_orderkey * 3) % 25) * 3 AS DOUBLE) AS BloodPressure,
           CAST(((o_orderkey * 7 + o_custkey) % 20) * 3 AS DOUBLE) AS SkinThickness,
           CAST(((o_custkey * 11) % 31) * 10 AS DOUBLE) AS Insulin,
           18.0 + CAST((o_orderkey * 5 + o_custkey * 3) % 32 AS DOUBLE) / 2.0 AS BMI,
           CAST((o_custkey * 13 + o_orderkey) % 29 AS DOUBLE) / 20.0 AS DiabetesPedigreeFunction,
           CAST(21 + (o_orderkey * 11 + o_custkey * 7) % 30 AS INTEGER) AS Age
    FROM orders))"""

HEART_SQL = """
SELECT o_orderkey, age, sex, cp, trestbps, chol, fbs, restecg, thalach, exang, oldpeak, slope, ca, thal,
       CASE WHEN o_orderkey % 11 = 0 THEN 1 - r ELSE r END AS risk,
       substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 4) < 'cccc' AS is_train
FROM (
  SELECT *, CAST((cp >= 3 AND thalach < 150) OR (oldpeak >= 3.0 AND exang = 1) OR (ca >= 2 AND age >= 50) AS INTEGER) AS r
  FROM (
    SELECT o_orderkey,
           CAST(29 + (o_orderkey * 3) % 31 AS INTEGER) AS age,
           CAST(o_custkey % 2 AS INTEGER) AS sex,
           CAST(1 + o_orderkey % 4 AS INTEGER) AS cp,
           CAST(94 + (o_custkey % 30) * 3 AS INTEGER) AS trestbps,
           CAST(126 + ((o_orderkey * 7) % 32) * 10 AS INTEGER) AS chol,
           CAST(o_orderkey % 7 = 0 AS INTEGER) AS fbs,
           CAST(o_custkey % 3 AS INTEGER) AS restecg,
           CAST(71 + ((o_orderkey * 5 + o_custkey) % 31) * 4 AS INTEGER) AS thalach,
           CAST((o_orderkey + o_custkey) % 2 AS INTEGER) AS exang,
           CAST((o_orderkey * 13) % 31 AS DOUBLE) / 5.0 AS oldpeak,
           CAST(1 + (o_orderkey + o_custkey) % 3 AS INTEGER) AS slope,
           CAST((o_orderkey * 3 + o_custkey) % 4 AS INTEGER) AS ca,
           CAST(1 + (o_orderkey * 11) % 3 AS INTEGER) AS thal
    FROM orders))"""
