import tempfile

import pytest

from tallyline.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="tallyline-warehouse-")
    session = local_session(4, "tests", partitions=4, **{"spark.sql.warehouse.dir": warehouse})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
