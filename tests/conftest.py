import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from eventide.session import get_session
    s = get_session("local[*]", shuffle_partitions=8, app="eventide-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    """A fresh directory for one test."""
    return tempfile.mkdtemp(prefix="eventide-test-")
