import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tiersmith.session import build_session, shared_dir

    s = build_session("local[*]", "tiersmith-tests", shuffle_partitions=8)
    shared_dir(s)  # a private checkpoint folder only when the session names none
    yield s
    s.stop()
