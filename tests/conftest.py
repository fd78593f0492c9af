from __future__ import annotations

import pytest

from sluiceway.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # Keeps the Python state server of the streaming tests off the network.
    session = local_session(8, "tests", **{"spark.python.unix.domain.socket.enabled": "true", "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf() -> str:
    return SMALL
