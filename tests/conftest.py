import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import build_session, checkpoint_root
    s = build_session("local[4]", "ledgerlake-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    checkpoint_root(s)   # shared folder from the session, or a private one when unset
    yield s


@pytest.fixture()
def lake(spark):
    from ledgerlake.session import scratch_path
    from ledgerlake.sources.lake import Lake
    return Lake(spark, scratch_path(spark, "test-lake"))
