import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kinspark.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("tests", "local[4]", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
