from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tests.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(parallelism=2)
    yield session
    session.stop()


@pytest.fixture
def folder() -> str:
    """A new folder for the files of one test."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
