import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from textspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """A frame of (id, text) rows from plain strings."""

    def make(*values):
        return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id bigint, text string")

    return make


@pytest.fixture
def column(texts):
    """Applies a Column -> Column function to strings and returns the values."""
    from pyspark.sql import functions as F

    def run(fn, *values):
        return [r.out for r in texts(*values).select("id", fn(F.col("text")).alias("out")).orderBy("id").collect()]

    return run
