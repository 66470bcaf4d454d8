import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("saleslake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # Some tests read the plans that have run; by default the oldest of 1,000 go.
        .config("spark.sql.ui.retainedExecutions", "100000")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="saleslake-tests-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="saleslake-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("lake"))
