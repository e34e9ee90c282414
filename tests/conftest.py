import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lendlake.session import checkpoint_dir, local_session

    s = local_session(cores="*", shuffle_partitions=8, app="lendlake-tests")
    checkpoint_dir(s)  # tests set their own scratch folder (unset otherwise)
    yield s
    s.stop()
