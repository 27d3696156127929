import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "scripts"))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from goldleaf.session import build_session
    s = build_session("local[*]", shuffle_partitions=8, app_name="goldleaf-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from check_oracle import duck_connect
    return duck_connect(SMOKE_DIR)
