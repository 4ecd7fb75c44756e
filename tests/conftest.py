import pathlib
import sys
import tempfile

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from roadpulse.session import build_session

    session = build_session(
        "tests", "local[8]", 4, spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g", spark__checkpoint__dir=tempfile.mkdtemp(prefix="roadpulse-tests-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
