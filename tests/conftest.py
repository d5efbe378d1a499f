import pytest

from attestry import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("attestry-tests", cores=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
