import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidepool.session import get_spark
    work = tempfile.mkdtemp(prefix="tidepool-tests-")
    s = get_spark("local[4]", 4, extra={"spark.checkpoint.dir": work})
    yield s
    s.stop()
