import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from saleskeep.workspace import Workspace  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("saleskeep-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def limits(spark):
    """Set how many bytes are broadcast and how many rows make a key hot, for one test."""
    names = ("spark.saleskeep.broadcastBytes", "spark.saleskeep.hotRows")

    def set_limits(broadcast_bytes, hot_rows):
        for name, value in zip(names, (broadcast_bytes, hot_rows)):
            spark.conf.set(name, value)

    yield set_limits
    for name in names:
        spark.conf.unset(name)


@pytest.fixture
def workspace(spark, tmp_path):
    return Workspace(spark, str(tmp_path))
