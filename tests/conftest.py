from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from quillstack.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, spark__sql__execution__arrow__maxRecordsPerBatch="500")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
