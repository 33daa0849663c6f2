import datetime
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tarnwork.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def rows():
    """A frame as a sorted list of tuples; NULLs sort first."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])

    return collect


def day(text):
    return datetime.date.fromisoformat(text)
