import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from storelens.session import drop_scratch, local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(folder=str(tmp_path_factory.mktemp("spark")))
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
