"""The clinical-shaped tables keep the conditions that make trees exact."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from riskloom.plans import clinical
from riskloom.sources.table import parse_form
from riskloom.specs import DIABETES, HEART


@pytest.mark.parametrize("spec,rows", [(DIABETES, clinical.diabetes_rows), (HEART, clinical.heart_rows)])
def test_schema_bins_and_labels(spark, spec, rows):
    df = rows(spark.read.parquet(f"{SF_MID}/orders.parquet"))
    assert [f for f in df.schema.fields if f.name != clinical.KEY] == list(spec.schema.fields)
    counts = df.agg(*[F.countDistinct(c).alias(c) for c in spec.features]).first().asDict()
    assert max(counts.values()) <= 32  # every candidate split is a midpoint under 32 bins
    share = df.agg(F.avg(spec.label)).first()[0]
    assert 0.2 < share < 0.8  # both classes well represented


def test_parse_form_is_strict():
    assert parse_form(DIABETES, clinical.DIABETES_FORMS[0][1])[0] == 2
    with pytest.raises(ValueError):
        parse_form(DIABETES, ("2.5",) + clinical.DIABETES_FORMS[0][1][1:])
