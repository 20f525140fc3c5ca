import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import build_session, shared_dir
    s = build_session(master="local[4]", shuffle_partitions=4)
    shared_dir(s)
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from ledgerlake.session import scratch_path
    return lambda name="t": scratch_path(spark, name)
