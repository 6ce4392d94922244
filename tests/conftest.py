"""One local session for all tests."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quillmesh.session import build, ship_package

    session = build(4, partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield ship_package(session)
    session.stop()


@pytest.fixture(scope="session")
def tables():
    return "/root/testdata/sf0.001"
