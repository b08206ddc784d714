import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from eventloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("checkpoint"))
    session = local_session(4, memory="6g", name="tests", spark__checkpoint__dir=shared)
    yield session
    session.stop()
