import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from basketlens.session import build_session, ensure_checkpoint_dir

    session = build_session(master="local[4]", shuffle_partitions=4, app_name="basketlens-tests")
    ensure_checkpoint_dir(session, str(tmp_path_factory.mktemp("ckpt")))
    yield session
    session.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
