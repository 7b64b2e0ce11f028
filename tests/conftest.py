import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from rowtide.session import get_session
    s = get_session("local[4]", app="rowtide-tests", shuffle_partitions=4)
    yield s
    s.stop()
