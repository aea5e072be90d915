import os
import sys

import pytest
from pyspark import SparkContext
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from herdframe.session import local_session  # noqa: E402


@pytest.fixture(scope="module")
def spark():
    """A session for each test file. If an earlier one has taken its JVM with it, a new JVM is started, so the files that follow still run."""
    try:
        session = local_session(8, "tests")
        session.range(1).count()
    except Exception:
        SparkContext._active_spark_context = SparkContext._gateway = SparkContext._jvm = None
        SparkSession._instantiatedSession = None
        session = local_session(8, "tests")
    yield session
    session.stop()
