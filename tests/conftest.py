import pytest

from kithscope.session import local_session

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
