import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ.setdefault("PYTHONPATH", ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from roundbook.plans.config import ensure_checkpoint_dir, local_session

    s = local_session(4, shuffle_partitions=8, app="roundbook-tests")
    if not s.sparkContext.getCheckpointDir() and not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rb-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="rb-test-")
