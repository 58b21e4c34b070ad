import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from quoteline.session import SESSION_DEFAULTS

    builder = (
        SparkSession.builder.master("local[4]")
        .appName("quoteline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # Tests run without a cluster, so the shared checkpoint folder is unset: use a fresh one.
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quoteline-test-ckpt-"))
    yield session


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="quoteline-test-")
