"""One Spark session for all tests."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="chronoweave-test-")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", folder)
        .config("spark.local.dir", folder)
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
