import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tablesync.session import build_session

    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tablesync-tests",
        spark__master="local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="3",
        spark__sql__warehouse__dir=str(folder / "warehouse"),
        spark__checkpoint__dir=str(folder / "shared"),
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
