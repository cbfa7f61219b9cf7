import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clusterlens.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="clusterlens-tests")
    yield s


def one(spark, expr, schema="x string", rows=None):
    """Evaluate a Column expression over literal rows; returns the list of values."""
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]
