import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import build_session
    ckpt = tempfile.mkdtemp(prefix="ledgerlake-test-ckpt-")
    s = build_session("local[4]", app="ledgerlake-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="ledgerlake-test-")
