import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         # one session runs the whole suite: the default heap of 1 GB ran out in its last modules
         .config("spark.driver.memory", "3g")
         .config("spark.sql.ui.retainedExecutions", "50")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="module", autouse=True)
def caches_cleared():
    """Nothing that a module's tests have cached stays in the session."""
    yield
    from pyspark.sql import SparkSession

    if active := SparkSession.getActiveSession():
        active.catalog.clearCache()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
