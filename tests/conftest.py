import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata"


def build(**extra):
    builder = SparkSession.builder
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return (
        builder.master("local[8]")
        .appName("dayfold-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build()
    if not session.conf.get("spark.checkpoint.dir", None):
        session.stop()
        session = build(spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_options(**options):
        for name, value in options.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_options
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture
def shared_dir(spark):
    """The checkpoint folder; the tests' own only where the session names none."""
    return spark.conf.get("spark.checkpoint.dir")
