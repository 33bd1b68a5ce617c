"""One small session for all tests."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

from loomwright.session import local  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local(4, partitions=4, memory="4g")
    yield session
    session.stop()
