import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from dimloom.session import local_session

    s = local_session("*", shuffle_partitions=8, app="dimloom-tests")
    yield s
    s.stop()


@pytest.fixture()
def tables(spark):
    """Registry over the source project's sample rows."""
    from reference_fixture import ROWS

    from dimloom.sources import from_rows

    return from_rows(spark, ROWS)
