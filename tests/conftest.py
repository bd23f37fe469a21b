import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="batchgate-tests-")
    s = (SparkSession.builder.master("local[4]").appName("batchgate-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
         .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(spark):
    from batchgate.session import scratch_path
    return scratch_path(spark, "test")
