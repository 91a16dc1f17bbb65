from __future__ import annotations

import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

NOW = datetime(2026, 8, 15, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    from digestry.session import drop_staged, local_session

    session = local_session(8, partitions=4)
    yield session
    drop_staged(session)
    session.stop()


@pytest.fixture
def now():
    return NOW
