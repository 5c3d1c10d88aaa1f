import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lexiflow.session import build_session

    s = build_session("local[4]", 8, app_name="lexiflow-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lexiflow-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="lexiflow-test-", dir="/tmp")


SF_SMALL = "/root/testdata/sf0.001"
