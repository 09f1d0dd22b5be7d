import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dimspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Small partitions are not merged, so that even small tables have several slices.
    session = local_session(4, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ts():
    """A timestamp from a day number, or from ISO text."""

    def make(value):
        if value is None:
            return None
        if isinstance(value, str):
            return dt.datetime.fromisoformat(value)
        return dt.datetime(2020, 1, 1) + dt.timedelta(days=value)

    return make


@pytest.fixture
def rows():
    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)

    return collect
