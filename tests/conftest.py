import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from changeloom import schemas  # noqa: E402
from changeloom.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "changeloom-tests", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def dimension(spark):
    return schemas.tenants(spark)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
