import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = {
    "0.001": "/root/testdata/sf0.001",
    "0.01": "/root/testdata/sf0.01",
}


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="tierflow-test-", dir="/tmp")


@pytest.fixture(scope="session")
def spark(scratch):
    from tierflow.session import checkpoint_root, local_session

    s = local_session("*", 8, warehouse=os.path.join(scratch, "warehouse"))
    checkpoint_root(s, fallback=os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(scratch):
    return tempfile.mkdtemp(dir=scratch)
