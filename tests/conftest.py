"""One small session for all tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plotmill.session import get_spark

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_spark(master="local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def one(spark):
    """Evaluate a column over one row of literals."""

    def run(column, **values):
        from pyspark.sql import functions as F

        row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
        return row.select(column.alias("x")).first()["x"]

    return run
