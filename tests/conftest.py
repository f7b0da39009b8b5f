import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from duebook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, partitions=4)
    yield s
    s.stop()
