import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barlake.session import build_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="barlake-tests", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    shared_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="barlake-test-")


SF = "/root/testdata/sf0.001"
