import pytest

from tests.compare import ROOT, duck, spark_session


@pytest.fixture(scope="session")
def spark():
    return spark_session()


@pytest.fixture(scope="session")
def sf():
    return f"{ROOT}/sf0.001"


@pytest.fixture(scope="session")
def con(sf):
    return duck(sf)
