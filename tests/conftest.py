import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridsight.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test data here")
    return path
