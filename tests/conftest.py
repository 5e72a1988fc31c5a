import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# Test modules hold functions that run inside tasks.
os.environ["PYTHONPATH"] = os.pathsep.join(sys.path[:2])

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from kanaat.session import local_session

    session = local_session("4", shuffle_partitions=4, memory="6g")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    from compare import connect

    return connect(SMALL)


@pytest.fixture(scope="session")
def small():
    return SMALL
