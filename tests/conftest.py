import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfmark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cores=8, partitions=4)
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()
