import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("TIDEMARK_PARTITIONS", "4")
    from tidemark.session import local_session

    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    # The shared folder of the tests; a cluster names its own.
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"
