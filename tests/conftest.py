import os
import sys
import tempfile
import warnings

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
warnings.filterwarnings("ignore")
os.environ.setdefault("PYTHONWARNINGS", "ignore")

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session

    ckpt = tempfile.mkdtemp(prefix="tessera-test-ckpt-")
    s = build_session("local[4]", app_name="tessera-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tessera-test-")
