import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from areaweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "areaweave-tests",
        "local[8]",
        8,
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('scratch')}",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
