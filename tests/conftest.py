import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from leadpulse.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="leadpulse-test-ckpt-")
    session = build_session("local[8]", app_name="leadpulse-tests", shuffle_partitions=8,
                            conf={"spark.driver.memory": "8g", "spark.checkpoint.dir": ckpt,
                                  "spark.sql.sources.parallelPartitionDiscovery.threshold": "4096"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
