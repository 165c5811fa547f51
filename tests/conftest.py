import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terrace.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    found = session(
        "terrace-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__checkpoint__dir=str(root / "shared"),
        spark__sql__warehouse__dir=str(root / "warehouse"),
        spark__driver__memory="6g",
    )
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()
