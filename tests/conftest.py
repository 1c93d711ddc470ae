import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from parcelgrid.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8, "parcelgrid-tests", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def own_intermediates(monkeypatch):
    """Each test sees the folders it has written itself, whatever ran before."""
    from parcelgrid import session

    monkeypatch.setattr(session._written, "paths", [])


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """Make every join shuffle, as it does for large tables."""
    from parcelgrid.operators import overlap, skew

    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(overlap, "BROADCAST_ROWS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
