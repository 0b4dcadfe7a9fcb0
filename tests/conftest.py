import pytest

from galena.session import build_session


@pytest.fixture(scope="session")
def spark():
    s = build_session("galena-tests", "4", spark__sql__shuffle__partitions="4", spark__default__parallelism="4")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
