import shutil
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


from tripmart.session import release  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="tripmart-tests-")  # stands for the cluster's shared folder
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", f"file://{shared}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)
    session.stop()
    shutil.rmtree(shared)


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    """Run a test under two session time zones."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
