import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from shelfwise.session import build_session
    s = build_session("local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def lib(spark):
    from fixtures import library_tables
    return library_tables(spark)


@pytest.fixture(scope="session")
def as_of():
    from fixtures import AS_OF
    return AS_OF
