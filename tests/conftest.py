import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from molarflow.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="mf-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="mf-test-")
