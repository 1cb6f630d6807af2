import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import build_session, ensure_checkpoint_dir

    s = build_session("local[4]", 4)
    ensure_checkpoint_dir(s)  # tests only: a local folder when none is configured
    yield s
    s.stop()
