import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from chronoroll.session import build_session
    s = build_session("chronoroll-tests", master="local[4]", shuffle_partitions=8)
    # tests run without a cluster: give them their own checkpoint folder
    # only when the session names none
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="chronoroll-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
