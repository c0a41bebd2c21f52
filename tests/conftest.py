import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]  # the package; the tests' own helpers


@pytest.fixture(scope="session")
def spark():
    from lineforge.session import clear_scratch, local_session
    s = local_session("*", shuffle_partitions=8, app="lineforge-tests")
    yield s
    clear_scratch(s)
    s.stop()
