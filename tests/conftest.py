import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from finmesh.session import get_session
    s = get_session("local[*]", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="finmesh-warehouse-")})
    yield s
    from finmesh.session import cleanup_scratch
    cleanup_scratch(s)
    s.stop()
