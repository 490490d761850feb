from __future__ import annotations

import math

import pytest

from riskloom.functions import (
    accuracy_percent,
    parse_double,
    parse_int,
    round_half_even,
    verdict_code,
    verdict_colour,
    verdict_message,
)
from riskloom.specs import DIABETES, HEART


def test_parse_tolerant(spark):
    df = spark.createDataFrame([("5",), ("6.9",), ("x",), ("",), (None,), ("-3",)], ["s"])
    got = [r[0] for r in df.select(parse_int("s", strict=False)).collect()]
    assert got == [5, None, None, None, None, -3]
    got = [r[0] for r in df.select(parse_double("s", strict=False)).collect()]
    assert got == [5.0, 6.9, None, None, None, -3.0]


def test_parse_strict_raises(spark):
    df = spark.createDataFrame([("5",), ("6.9",)], ["s"])
    with pytest.raises(Exception):
        df.select(parse_int("s", strict=True)).collect()
    ok = spark.createDataFrame([("5",), ("7",)], ["s"])
    assert [r[0] for r in ok.select(parse_int("s", strict=True)).collect()] == [5, 7]


def test_round_half_even_matches_python(spark):
    vals = [0.5, 1.5, 2.5, -0.5, 0.49, 0.51, 3.0, 24.5]
    df = spark.createDataFrame([(v,) for v in vals], ["x"])
    got = [r[0] for r in df.select(round_half_even("x")).collect()]
    assert got == [round(v) for v in vals]


@pytest.mark.parametrize(
    "spec,expected",
    [
        (DIABETES, {0: ("person is not diabetic", "0", "green"), 1: ("person is diabetic", "1", "red"),
                    2: ("person is diabetic", "1", "red")}),
        (HEART, {0: ("person is not having heart disease", "0", "green"),
                 1: ("person is having heart disease", "1", "red"),
                 2: ("person is not having heart disease", "0", "green")}),
    ],
)
def test_verdict_rules(spark, spec, expected):
    df = spark.createDataFrame([(p,) for p in expected], ["p"])
    rows = df.select(
        "p",
        verdict_message("p", spec.verdict).alias("m"),
        verdict_code("p", spec.verdict).alias("v"),
        verdict_colour("p", spec.verdict).alias("c"),
    ).collect()
    assert {r.p: (r.m, r.v, r.c) for r in rows} == expected


def test_accuracy_percent_rounds_up_and_handles_empty(spark):
    df = spark.createDataFrame([(0.801,), (0.07,), (1.0,), (None,), (float("nan"),)], "a double")
    got = [r[0] for r in df.select(accuracy_percent("a")).collect()]
    assert got == [81, math.ceil(0.07 * 100), 100, None, None]
