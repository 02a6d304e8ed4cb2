import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tracelode.session import local_session, scratch_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("4", shuffle_partitions=4, app="tests")


@pytest.fixture()
def scratch(spark):
    """A fresh folder path per test."""
    return scratch_dir(spark, "test")


@pytest.fixture()
def fixture_file():
    return lambda name: str(Path(__file__).parent / "fixtures" / name)
