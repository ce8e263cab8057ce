import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ruleweave.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(monkeypatch):
    """Send every side table down the salted path."""
    from ruleweave.operators import stages

    monkeypatch.setattr(stages, "BROADCAST_LIMIT", -1)


@pytest.fixture
def small_pieces(monkeypatch):
    """Take every repeated key as a hot one."""
    from ruleweave.operators import stages

    monkeypatch.setattr(stages, "ROWS_PER_PIECE", 1)


@pytest.fixture
def fixed_plans(spark):
    """Plans without broadcasts and without changes while they run."""
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)
