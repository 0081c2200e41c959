import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="segmenta-test-")
    s = (SparkSession.builder.master("local[*]").appName("segmenta-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.driver.memory", "6g")  # one JVM for all tests
         .config("spark.sql.ui.retainedExecutions", "20")
         .config("spark.ui.retainedJobs", "100")
         .config("spark.ui.retainedStages", "200")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="segmenta-run-")
