import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pathlattice.session import build_session  # noqa: E402
from seed_graph import seed_map_json  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[8]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def seed_map_path(tmp_path):
    p = tmp_path / "seed.json"
    p.write_text(seed_map_json())
    return str(p)
