import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from vestigo.session import build_session

    session = build_session(4, partitions=4, memory="4g")
    yield session
    session.stop()


DATA = Path("/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def folder():
    if not DATA.exists():
        pytest.skip("no test tables on this machine")
    return str(DATA)
