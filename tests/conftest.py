import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import checkpoint_dir, get_session

    scratch = tempfile.mkdtemp(prefix="tessera-test-")
    s = get_session("local[4]", app="tessera-tests", shuffle_partitions=8,
                    conf={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")})
    checkpoint_dir(s, tempfile.mkdtemp(prefix="tessera-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tessera-test-")
