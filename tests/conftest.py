import pytest

from tests.oracle import ROOT, connect, session

SF = f"{ROOT}/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = session()
    yield s
    s.stop()


@pytest.fixture(scope="session")
def con():
    return connect(SF)


@pytest.fixture(scope="session")
def tables(spark):
    from foldwise.catalog.bind import Tables
    return Tables(spark, SF)
