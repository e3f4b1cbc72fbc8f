import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def event_log():
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture(scope="session")
def spark(event_log):
    # The zone is deliberately not UTC: no result may depend on it.
    session = (
        SparkSession.builder.master("local[4]")
        .appName("firstmile-tests")
        .config("spark.ui.enabled", False)
        .config("spark.sql.shuffle.partitions", 4)
        .config("spark.sql.session.timeZone", "America/Sao_Paulo")
        .config("spark.sql.maxMetadataStringLength", 2000)
        .config("spark.eventLog.enabled", True)
        .config("spark.eventLog.compress", False)
        .config("spark.eventLog.dir", event_log)
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
