import os

import pytest

from pulsegrid.runtime import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(os.environ.get("TEST_CPUS", "4"), "pulsegrid-tests", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
