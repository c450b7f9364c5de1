import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from affinity.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app="affinity-tests", extra={"spark.driver.memory": "6g"})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="affinity-test-")


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path
