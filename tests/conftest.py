import os
import sys
from datetime import datetime, timedelta, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ubeat.session import get_session  # noqa: E402

EPOCH = datetime(1970, 1, 1)


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="ubeat-tests", shuffle_partitions=4)
    yield s
    s.stop()


def ts(seconds: float) -> datetime:
    """Naive UTC datetime (TIMESTAMP_NTZ) from epoch seconds."""
    return EPOCH + timedelta(seconds=seconds)


def utc(seconds: float) -> datetime:
    return datetime.fromtimestamp(seconds, tz=timezone.utc).replace(tzinfo=None)


def _key(t):
    return tuple((x is None, 0 if x is None else x) for x in t)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)
