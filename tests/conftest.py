import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from marquee.session import get_session, workspace_dir
    s = get_session("local[4]", shuffle_partitions=4)
    workspace_dir(s)  # uses the session's spark.checkpoint.dir; creates one only if unset
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from marquee.session import workspace_dir
    return workspace_dir(spark)
