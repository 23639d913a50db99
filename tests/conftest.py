import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = os.environ.get("TEST_SF_SMALL", "/root/testdata/sf0.001")
SF_CHECK = os.environ.get("TEST_SF_CHECK", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    ckpt = tempfile.mkdtemp(prefix="run-tests-ckpt-", dir="/tmp")
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.checkpoint.dir", ckpt)
         .config("spark.driver.memory", "8g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def workdir():
    """A fresh folder per test (never cleared, never reused)."""
    return tempfile.mkdtemp(prefix="run-test-", dir="/tmp")
