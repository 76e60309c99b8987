import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from metroflux.session import get_session
    s = get_session("local[4]", app="metroflux-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="mf-test-ckpt-"),
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="mf-test-wh-")})
    yield s
    s.stop()
