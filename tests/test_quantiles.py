"""Exact quantile cuts, and trees fitted on them."""

import math
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.operators.model import compiled_prediction, load_model, save_model
from riskloom.operators.prepare import assemble
from riskloom.operators.quantiles import binned, fit_quantile_tree, quantile_cuts
from riskloom.session import shared_path
from riskloom.specs import TreeParams


def expected(values, bins):
    found = sorted(v for v in values if v is not None and not math.isnan(v))
    distinct = sorted(set(found))
    if len(distinct) <= bins:
        return [(a + b) / 2 for a, b in zip(distinct, distinct[1:])]
    ranks = [math.ceil(j * len(found) / bins) for j in range(1, bins)]
    return sorted({found[r - 1] for r in ranks} - {found[-1]})


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e300, 1e300), st.just(math.nan), st.sampled_from([0.0, 1.5, 1e-300])), max_size=60))
def test_cuts_are_the_ranked_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert quantile_cuts(df, ["x"], 4)["x"] == expected(values, 4)


def test_cuts_of_uneven_values_in_any_layout(spark):
    draw = np.random.default_rng(3)
    values = np.concatenate([np.full(700, 2.0), draw.lognormal(0, 6, 1500), -draw.random(300), [np.nan]])
    rows = [(float(v), 1.0) for v in draw.permutation(values)]
    df = spark.createDataFrame([*rows, (None, 1.0)], "x double, constant double")
    cuts = quantile_cuts(df, ["x", "constant"], 32)
    assert cuts == {"x": expected([v for v, _ in rows], 32), "constant": []}
    assert quantile_cuts(df.repartition(7), ["x", "constant"], 32) == cuts
    found = binned(df, cuts).groupBy((F.col("x").isNull() | F.isnan("x")).alias("none")).agg(F.count("x_bin").alias("n"), F.max("x_bin").alias("top"))
    assert {r["none"]: (r["n"], r["top"]) for r in found.collect()} == {True: (0, None), False: (2500, float(len(cuts["x"])))}
    below = binned(df, cuts).where("x_bin is not null").select("x", "x_bin").collect()
    assert all(r["x_bin"] == sum(c < r["x"] for c in cuts["x"]) for r in below)


def test_no_rows_have_no_cuts(spark):
    df = spark.createDataFrame([], "x double, y int")
    assert quantile_cuts(df, ["x", "y"]) == {"x": [], "y": []}
    with pytest.raises(ValueError):
        quantile_cuts(df, ["x"], 1)


@pytest.mark.parametrize("kind", ["classifier", "regressor"])
def test_tree_takes_values_and_keeps_its_bins_predictions(spark, kind):
    draw = np.random.default_rng(5)
    x, z = draw.normal(30, 7, 1200), draw.exponential(2, 1200)
    rows = [(float(a), float(b), int(a + 3 * b + c > 36)) for a, b, c in zip(x, z, draw.normal(0, 2, 1200))]
    df = spark.createDataFrame(rows, "x double, z double, y int")
    model = fit_quantile_tree(df, ["x", "z"], kind, "y", TreeParams(seed=1), num_classes=2)
    other = fit_quantile_tree(df.repartition(5), ["x", "z"], kind, "y", TreeParams(seed=9), num_classes=2)
    text = model.toDebugString.split("\n", 1)[1]
    assert text == other.toDebugString.split("\n", 1)[1]  # neither seed nor layout counts
    thresholds = {float(t) for t in re.findall(r"<= ([-\d.E]+)\)", text)}
    cuts = quantile_cuts(df, ["x", "z"])
    assert thresholds and thresholds <= {*cuts["x"], *cuts["z"]}
    path = shared_path(spark, "quantile-tree")
    save_model(model, path)
    scored = load_model(spark, path).transform(assemble(df, ["x", "z"]))
    assert scored.where(F.col("prediction") != compiled_prediction(model, ["x", "z"])).count() == 0
    assert scored.agg(F.avg((F.bround("prediction") == F.col("y")).cast("double"))).first()[0] > 0.85
