import pytest

from sluice.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
