import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from narrata.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="8g", app="narrata-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """Make a frame of (id, text) from a list of texts."""
    return lambda values: spark.createDataFrame(list(enumerate(values)), "id long, text string")


def values(df, column, key="id"):
    return [r[column] for r in df.orderBy(key).select(column).collect()]


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
