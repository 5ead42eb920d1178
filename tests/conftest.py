import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tallyhouse.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    # Month files of tiny tables are written by several tasks at once.
    session.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    yield session
    session.stop()


class Given:
    """Tables made in a test, by name."""

    def __init__(self, **frames):
        self.frames = frames

    def table(self, name):
        return self.frames[name]


@pytest.fixture
def given():
    return Given
