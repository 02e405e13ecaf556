import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from wardgrid import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "wardgrid-tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="6g"
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
