import sys
import uuid
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from obs_engine.session import local_session, scratch_path  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def connection():
    from compare import duck

    return duck(SF_DIR)


@pytest.fixture
def folder(spark):
    return scratch_path(spark, f"test-{uuid.uuid4().hex[:6]}")
