import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from spendlens.session import build_session
    ckpt = tempfile.mkdtemp(prefix="spendlens-ckpt-")
    s = build_session(app="spendlens-tests", master="local[*]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "6g", "spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="spendlens-test-")
