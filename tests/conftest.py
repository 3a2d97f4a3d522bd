from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from delaylake.session import local_session, release_scratch  # noqa: E402
from delaylake.sinks.lake import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, memory="4g", warehouse=str(tmp_path_factory.mktemp("warehouse")))
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    release_scratch(session)
    session.stop()


@pytest.fixture
def lake(spark):
    return Lake.scratch(spark, "test")
