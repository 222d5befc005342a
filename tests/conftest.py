import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from packhouse.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("packhouse-tests", cpus=os.environ.get("TEST_CPUS", "8"))
    yield session
    session.stop()
