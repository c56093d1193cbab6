import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lorekeel.session import build_session

    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[4]",
        spark__sql__shuffle__partitions="4", spark__default__parallelism="4", spark__driver__memory="4g",
        spark__local__dir=str(folder / "local"), spark__sql__warehouse__dir=str(folder / "warehouse"), spark__checkpoint__dir="file://" + str(folder / "shared"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    """The smallest of the given data sets."""
    return "/root/testdata/sf0.001"
