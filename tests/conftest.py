import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from draftlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, "tests", shuffle_partitions=8)
    yield s
    s.stop()
