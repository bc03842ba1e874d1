import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from swapbook.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[8]", shuffle_partitions=8, driver_memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")
