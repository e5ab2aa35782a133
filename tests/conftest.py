import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tripflow.session import build_local_session

    wh = tempfile.mkdtemp(prefix="tripflow-wh-")
    s = build_local_session(4, app="tripflow-tests", shuffle_partitions=8,
                            spark__sql__warehouse__dir=wh)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tripflow-test-")
