import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import local_session

    warehouse = tempfile.mkdtemp(prefix="ledgerlake-wh-", dir="/tmp")
    session = local_session("*", shuffle_partitions=8, warehouse=warehouse)
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ledgerlake-test-", dir="/tmp")
