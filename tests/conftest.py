from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = Path(os.environ.get("TIDEMARK_TEST_DATA", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    os.environ.setdefault("TIDEMARK_DRIVER_MEMORY", "4g")
    session = local_session(4, shuffle_partitions=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    if not DATA.exists():
        pytest.skip("no test data")
    return str(DATA)


@pytest.fixture(scope="session")
def duck(data):
    from compare import connect

    return connect(data)
