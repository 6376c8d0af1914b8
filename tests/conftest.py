import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerstar.session import local_session

    session = local_session(cores="*", shuffle_partitions=8, app="ledgerstar-tests")
    yield session
    session.stop()


@pytest.fixture()
def wh(spark):
    from ledgerstar.sinks import Warehouse

    return Warehouse.fresh(spark, "test")
