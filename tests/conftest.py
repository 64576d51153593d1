import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from riskmart.session import build_session, shared_root
    warehouse = tempfile.mkdtemp(prefix="riskmart-wh-")
    session = build_session("local[4]", shuffle_partitions=8,
                            extra={"spark.sql.warehouse.dir": warehouse})
    shared_root(session)   # sets a checkpoint dir only when the session has none
    yield session
    session.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
