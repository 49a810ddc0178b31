import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    s = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.host", "127.0.0.1").config("spark.scheduler.mode", "FAIR").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def store(spark, tmp_path):
    from palimpsest.sources.store import VersionedStore

    return VersionedStore(spark, f"file://{tmp_path}/store", buckets=4)


@pytest.fixture
def state(spark, tmp_path):
    from palimpsest.sources.state import StateStore

    return StateStore(spark, f"file://{tmp_path}/state")
