import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from claimlens.session import local_session

    warehouse = tempfile.mkdtemp(prefix="claimlens-warehouse-")
    session = local_session("tests", cpus=8, **{"spark.sql.warehouse.dir": warehouse, "spark.sql.shuffle.partitions": "3"})
    yield session
    session.stop()


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)
