import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidal.session import get_session  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="tidal-test-ckpt-")
    s = get_session("local[*]", app="tidal-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tidal-test-")
