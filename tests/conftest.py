import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "tools"))


@pytest.fixture(scope="session")
def spark():
    from check import session

    s = session("4")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    yield s
    s.stop()
