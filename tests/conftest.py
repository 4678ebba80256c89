import os

os.environ.setdefault("OMP_NUM_THREADS", "1")

import pytest

from claimloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, 8, "4g")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return session
