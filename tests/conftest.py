import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from corvina.session import local_session, ship

    s = local_session(cores=4, shuffle=4, memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield ship(s)
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
