import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from adlake.session import get_session
    s = get_session("local[*]", shuffle_partitions=8, app_name="adlake-tests")
    yield s


@pytest.fixture(scope="session")
def duck():
    from tools.check_oracles import duck as mk
    return mk(SF_SMALL)
