import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidewise.session import get_spark

    s = get_spark("local[4]", app_name="tidewise-tests", shuffle_partitions=4,
                  extra_conf={"spark.driver.memory": "6g"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidewise-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("test data not available")
    return SF_SMALL


@pytest.fixture(scope="module", autouse=True)
def _nothing_cached_for_the_next_module():
    """Tables that a module's tests cached would replace the scans in the plans
    of the next one's."""
    yield
    from pyspark.sql import SparkSession

    if session := SparkSession.getActiveSession():
        session.catalog.clearCache()
