import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session, ship_package

    session = build_session(
        "tidemark-tests", "local[4]",
        spark__ui__enabled="false", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()
