import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from framelark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, "tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture
def tiny_limits(spark, monkeypatch):
    """Every group counts as oversized, so the distributed ways run."""
    from framelark.operators import suppress

    spark.conf.set("framelark.foldRows", "2")
    spark.conf.set("framelark.windowRows", "3")
    monkeypatch.setattr(suppress, "FIRST_BLOCK", 8)
    yield
    spark.conf.unset("framelark.foldRows")
    spark.conf.unset("framelark.windowRows")
