"""Physical-plan properties every query must keep (see PLANS.md)."""

from __future__ import annotations

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
from plan_report import plan_text, summarise  # noqa: E402

from riskloom.plans.queries import QUERIES  # noqa: E402

MAP_ONLY = {"score_batch", "score_diabetes", "score_heart", "round_predictions", "verdict_default_positive",
            "verdict_default_negative", "parse_requests", "hash_split", "cast_project", "sql_view_filter",
            "score_batch_rejects", "display_table"}


@pytest.fixture(scope="module")
def texts(spark):
    return {name: plan_text(fn(spark, SF_SMALL)) for name, fn in QUERIES.items()}


@pytest.fixture(scope="module")
def plans(texts):
    return {name: summarise(t) for name, t in texts.items()}


def test_grouped_counts_preaggregate_per_task(texts, plans):
    # a hot key is reduced inside every task before any row crosses the shuffle
    for name in ("dt_classifier_stump", "predict_probability", "dt_regressor_depth5"):
        assert "hashpartitioning" in plans[name]["exchanges"], name
        assert "partial_" in texts[name], name


def test_no_python_no_pair_joins_no_broadcast(plans):
    for name, p in plans.items():
        assert not p["python"], name
        assert not p["bad_joins"], name
        assert not p["broadcast"], name


def test_scoring_and_row_maps_do_not_shuffle(plans):
    for name in MAP_ONLY:
        assert not plans[name]["exchanges"], (name, plans[name]["exchanges"])


def test_nothing_is_dealt_round_robin(plans):
    for name, p in plans.items():
        assert "RoundRobinPartitioning" not in p["exchanges"], name


def test_split_invariants_need_no_keyed_shuffle(plans):
    assert set(plans["random_split_invariants"]["exchanges"]) == {"SinglePartition"}


def test_fit_input_store_write_and_stream_plans(spark):
    """The plans behind the returned ones: what the learner reads, the store gets and a micro-batch runs."""
    from pyspark.sql import functions as F

    from riskloom.operators.prepare import assemble
    from riskloom.operators.score import parse_requests
    from riskloom.plans import clinical
    from riskloom.plans import fixture as fx
    from riskloom.plans.queries.common import read_driver_table
    from riskloom.specs import HEART

    fit = assemble(fx.lineitem_risk(spark, SF_SMALL).where(F.col("is_train")), fx.FEATURES, keep=[fx.LABEL])
    p = summarise(plan_text(fit))
    assert not p["exchanges"] and "l_extendedprice" not in p["scans"][0][1]
    rows = clinical.heart_rows(read_driver_table(spark, SF_SMALL, "orders"))
    assert not summarise(plan_text(rows))["exchanges"]  # what the store write runs
    batch = parse_requests(clinical.text_requests(rows, HEART), HEART, strict=False, keep=[clinical.KEY])
    assert not summarise(plan_text(batch))["exchanges"]


def test_scans_read_only_needed_columns(plans):
    assert plans["hash_split"]["scans"][0][1] == "struct<o_orderkey:bigint>"
    assert "LessThan(c_acctbal,20.0)" in plans["sql_view_filter"]["scans"][0][2]
    for fmt, schema, _ in plans["score_heart"]["scans"]:
        assert schema == "struct<o_orderkey:bigint,o_custkey:bigint>"
