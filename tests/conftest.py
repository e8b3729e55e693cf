import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.run import oracle_connection, session  # noqa: E402
from shelfwright.session import tune  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    spark = tune(session())
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def con():
    return oracle_connection(SMALL)
