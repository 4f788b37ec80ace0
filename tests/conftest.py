import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from leafstat.session import get_spark
    s = get_spark("local[8]", 8, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="leafstat-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="leafstat-test-")
