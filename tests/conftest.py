import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("retailflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own shared folder only where the session has none
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="retailflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder below the session's shared root for one test."""
    from retailflow.config import run_folder

    return run_folder(spark, "test")
