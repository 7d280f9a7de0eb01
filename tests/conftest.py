import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from newsloom.session import build_session

    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="3", spark__driver__memory="8g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
