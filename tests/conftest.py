import os

import pytest

from gristmill.session import local_session

DATA = os.environ.get("GRISTMILL_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{DATA}/sf0.01"
