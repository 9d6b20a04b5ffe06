import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import local_session

    session = local_session(cpus="*", shuffle_partitions=8, app="ledgerlake-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
