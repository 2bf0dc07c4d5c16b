import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import cloudpickle  # noqa: E402

import ledgerloom  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402

cloudpickle.register_pickle_by_value(ledgerloom)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "ledgerloom-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__sql__warehouse__dir="/tmp/ledgerloom-warehouse",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
