import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratocast.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="stratocast-tests-")
    s = build_session(
        "local[*]",
        app_name="stratocast-tests",
        shuffle_partitions=8,
        conf={
            "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
            "spark.local.dir": os.path.join(scratch, "local"),
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        },
    )
    yield s
    s.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="stratocast-case-")
