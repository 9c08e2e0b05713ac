import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from meterlake.session import build_session

    scratch = tempfile.mkdtemp(prefix="meterlake-tests-")
    s = build_session("local[4]", 4, app_name="meterlake-tests", extra={
        "spark.local.dir": scratch,
        "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
        "spark.driver.memory": "4g",
    })
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="meterlake-t-")
