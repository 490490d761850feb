"""Property tests: Spark expressions against Python semantics, tree invariants."""

from __future__ import annotations

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskloom.functions import parse_double, parse_int, round_half_even
from riskloom.operators.model import fit_tree
from riskloom.operators.prepare import assemble
from riskloom.plans import fixture as fx
from riskloom.plans.jobs import metrics_frame

finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)
halves = st.integers(min_value=-2000, max_value=2000).map(lambda i: i / 2)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(finite, halves), min_size=1, max_size=200))
def test_round_half_even_is_python_round(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = [r[0] for r in df.select(round_half_even("x")).collect()]
    assert got == [round(x) for x in xs]


def _py_int(s):
    try:
        return int(s)
    except (TypeError, ValueError):
        return None


int_text = st.one_of(
    st.integers(min_value=-(2**31), max_value=2**31 - 1).map(str),
    st.integers(min_value=-1000, max_value=1000).map(lambda i: f"{i}.5"),
    st.sampled_from(["", "x", "1e3", "--1", "+7", " 12 ", "0x10", "NaN"]),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(int_text, min_size=1, max_size=100))
def test_tolerant_int_parse_is_python_int(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(parse_int("s", strict=False)).collect()]
    assert got == [_py_int(t) for t in texts]


def _py_float(s):
    try:
        x = float(s)
    except ValueError:
        return None
    return "nan" if math.isnan(x) else x


float_text = st.one_of(
    finite.map(repr),
    st.sampled_from(["", ".", "1.", ".5", "1.5f", "2d", "0x1p3", "1e3", "-1E-2", "+7", " 12 ", "inf", "-Infinity", "NaN", "1,5", "1e", "--1"]),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(float_text, min_size=1, max_size=100))
def test_tolerant_double_parse_is_python_float(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(parse_double("s", strict=False)).collect()]
    assert ["nan" if x is not None and math.isnan(x) else x for x in got] == [_py_float(t) for t in texts]


def test_tree_does_not_depend_on_partitioning(spark):
    base = fx.lineitem_risk(spark, SF_SMALL).where(F.col("is_train"))
    preds = []
    for parts in (1, 3, 7):
        data = assemble(base.repartition(parts), fx.FEATURES, keep=[fx.LABEL])
        model = fit_tree(data, "classifier", fx.LABEL, fx.DEEP)
        test = assemble(fx.lineitem_risk(spark, SF_SMALL).where(~F.col("is_train")), fx.FEATURES)
        preds.append(sorted((r.l_orderkey, r.l_linenumber, r.prediction) for r in
                            model.transform(test).select("l_orderkey", "l_linenumber", "prediction").collect()))
    assert preds[0] == preds[1] == preds[2]


def test_empty_test_set_metrics(spark):
    empty = spark.createDataFrame([], "prediction double, label int")
    m = metrics_frame(empty, "label").first()
    assert m.n_test == 0 and m.n_correct == 0
    assert m.accuracy is None and m.accuracy_percent is None
    assert not (isinstance(m.accuracy, float) and math.isnan(m.accuracy))


def test_hot_key_split_and_counts(spark):
    """One key holds a third of all rows: splits keep it whole, counts stay exact."""
    from riskloom.operators.evaluate import confusion
    from riskloom.operators.prepare import hash_split_flag

    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 2).cast("double").alias("prediction"),
        (F.col("id") % 5 == 0).cast("int").alias("label"),
    ).repartition(8)
    flagged = df.withColumn("t", hash_split_flag("k", 0.8))
    sides = flagged.where(F.col("k") == 0).groupBy("t").count().collect()
    assert len(sides) == 1 and sides[0]["count"] == n // 3  # the hot key sits on one side, whole
    got = {(r.prediction, r.label): r.n for r in confusion(df, "label").collect()}
    assert sum(got.values()) == n
    assert got[(1.0, 1)] == len([i for i in range(n) if i % 2 == 1 and i % 5 == 0])
    plan = confusion(df, "label")._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
