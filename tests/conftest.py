import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("tests", cpus=4, shuffle_partitions=4, driver_memory="3g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
