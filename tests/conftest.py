import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from penmark.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="penmark-test-ckpt-")
    s = build_session("local[4]", app="penmark-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="penmark-test-")
