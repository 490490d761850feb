"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as entry_mod  # noqa: E402
from check_oracles import _rows, duck  # noqa: E402

from riskloom.plans.oracle import oracle_sql  # noqa: E402
from riskloom.plans.queries import QUERIES  # noqa: E402

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLES) <= set(entry_mod.oracle_sql())


DUCK_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    # same column types on both sides
    dtypes = {d[0]: str(d[1]) for d in res.description}
    assert {c: DUCK_TYPES.get(t, t) for c, t in df.dtypes} == dtypes
    assert _rows(df.columns, df.collect()) == _rows(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].n_test > 0
