import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture
def rows(spark):
    """A table from tuples and a DDL schema, in one partition."""
    def make(data, schema):
        return spark.createDataFrame(data, schema).coalesce(1)
    return make
