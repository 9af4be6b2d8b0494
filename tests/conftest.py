import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from goldleaf.session import build_session, shared_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("goldleaf-tests", "local[*]", {"spark.sql.shuffle.partitions": "8"})
    shared_root(s)  # the cluster's checkpoint folder, or a local one in tests
    yield s
    s.stop()
