import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="strata-tests")
    yield s


@pytest.fixture
def layout(spark):
    from strata.workloads import _layout
    return _layout(spark, "test")
