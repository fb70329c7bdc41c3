import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lakeweave-wh-")})
    # A cluster names its shared folder in spark.checkpoint.dir; when it is
    # unset, lakeweave.session.shared_root registers a local one.
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
