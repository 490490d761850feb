"""No single plan of a pipeline stage grows long: the driver describes the whole plan again after each of its stages."""

from __future__ import annotations

import pytest

import corpus_pipeline
from riskloom.llm import mixing, near_dedup
from riskloom.session import table_path

from .conftest import SF

MOST = 10  # exchanges of a plan


@pytest.mark.parametrize("stage", [corpus_pipeline.near_dups, corpus_pipeline.mix])
def test_plans_of_a_stage_stay_short(spark, monkeypatch, stage):
    exchanges = {}

    def planned(df, label):  # noqa: ANN001, ANN202
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        exchanges[label] = sum("Exchange " in x for x in lines)
        return df

    for module in (corpus_pipeline, mixing, near_dedup):
        monkeypatch.setattr(module, "staged", lambda df, label, f=module.staged: f(planned(df, label), label))
    planned(stage(spark, spark.read.parquet(table_path(SF, "documents")), SF), "result")
    assert max(exchanges.values()) <= MOST, exchanges
