import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quire.session import get_session
    from quire.plans import dimstore
    s = get_session(master="local[*]", shuffle_partitions=8, app_name="quire-tests")
    dimstore.BUCKETS = 8        # small tables
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
