import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from shiftlake.session import REQUIRED_CONF, checkpoint_root

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("shiftlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    checkpoint_root(session)  # a folder of our own only when none is configured
    yield session
