import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from threadcorpus.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[4]", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
