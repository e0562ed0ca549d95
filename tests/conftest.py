import pytest
from bf_testdata import SF_ORACLE


@pytest.fixture(scope="session")
def spark():
    from barcodeforge.session import get_spark

    s = get_spark(master="local[4]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def duck_oracle():
    from barcodeforge.plans.compare import duck

    return duck(SF_ORACLE)


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
