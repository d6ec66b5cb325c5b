import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwheel.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="4", shuffle_partitions=4, app_name="cartwheel-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cartwheel-tests-"))
    s.conf.set("spark.sql.maxMetadataStringLength", "2000")  # plans name whole paths, however long the scratch folder's is
    yield s
    s.stop()
