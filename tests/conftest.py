import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fareflow.session import local_session
    s = local_session("*", 8, app="fareflow-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, tmp_path):
    return str(tmp_path)
