import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from millrace.session import local_session
    session = local_session(8, "6g", str(tmp_path_factory.mktemp("scratch")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def t(spark):
    from millrace.queries.registry import Tables
    return Tables(spark, SF)


@pytest.fixture(scope="session")
def con():
    from check import duck
    return duck(SF)
