import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from runway.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # build_session keeps the checkpoint folder the environment names and only
    # creates a private one when none is set
    s = build_session("local[4]", app="runway-tests", shuffle_partitions=4)
    yield s
    s.stop()
