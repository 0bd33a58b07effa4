from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def make_session(master: str = "local[8]"):
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="strata-test-")
    spark = (
        SparkSession.builder.master(master)
        .appName("strata-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", f"{scratch}/ckpt")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={scratch}/derby")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    s = make_session()
    yield s
    s.stop()
