"""One local session for all tests."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("rollcall-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck(sf_dir):
    from compare import connect

    con = connect(sf_dir)
    yield con
    con.close()


@pytest.fixture(scope="session")
def estate(spark, sf_dir):
    """The whole model graph with its shared tables stored, built once for all tests."""
    from rollcall import Estate
    from rollcall.plans.estate import SHARED
    from rollcall.sources.adapter import RetailAdapter

    return Estate(spark, RetailAdapter(spark, sf_dir)).settle(*SHARED)
