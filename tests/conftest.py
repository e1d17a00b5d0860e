import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from chargeline.session import build_session

    s = build_session("local[4]", 4, app_name="chargeline-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="chargeline-test-wh-")})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="chargeline-test-ckpt-"))
    yield s
    s.stop()
