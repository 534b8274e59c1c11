import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from docketflow.session import get_session

    s = get_session(app="docketflow-tests", cpus="8", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def duck001():
    from oracle_compare import duck_connect

    return duck_connect(SF001)


@pytest.fixture(scope="session")
def duck0001():
    from oracle_compare import duck_connect

    return duck_connect(SF0001)
