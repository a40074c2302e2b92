import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from qanat.session import build_session  # noqa: E402
from qanat.sources.shipping import ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(cores=4, shuffle_partitions=4, memory="4g")
    ship_package(session)
    yield session
    session.stop()
