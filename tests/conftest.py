from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session", autouse=True)
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("meterline-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="meterline-wh-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from meterline.session import pin

    yield pin(session)
    session.stop()


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
