import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.01"
SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from stratlab.session import get_spark
    s = get_spark("local[4]", app="stratlab-tests", shuffle_partitions=8)
    yield s
