import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tastelens.session import local_session

    scratch = str(tmp_path_factory.mktemp("scratch"))
    session = local_session(4, partitions=4, memory="4g", scratch=scratch)
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def folder():
    return FOLDER
