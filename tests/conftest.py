import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from planweave.session import session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = session("tests", cores="4", shuffle_partitions=4)
    s.sparkContext.setLogLevel("OFF")
    return s


@pytest.fixture(scope="session")
def data():
    return DATA
