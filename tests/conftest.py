import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("SATLENS_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from satlens.session import get_session
    s = get_session("local[4]", app="satlens-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def inputs(spark):
    from satlens.plans.registry import Inputs
    return Inputs(spark, SF)
