from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from riskloom.session import build_session

    s = build_session(
        "local[*]",
        app_name="riskloom-tests",
        shuffle_partitions=8,
        extra_conf={
            "spark.driver.memory": "8g",
            # spark.checkpoint.dir comes from the environment's Spark config;
            # riskloom.session.shared_root picks a local one only if it is unset
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="riskloom-test-warehouse-"),
        },
    )
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    """A fresh folder below the session's shared checkpoint folder."""
    from riskloom.session import local_path, shared_path

    p = local_path(shared_path(spark, "test"))
    os.makedirs(p, exist_ok=True)
    return p
