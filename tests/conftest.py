import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("TIDEMARK_ORACLE_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session
    session = local_session(cores=8, shuffle_partitions=8, app="tidemark-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
