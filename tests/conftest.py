import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from longrec.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g",
        spark__sql__sources__parallelPartitionDiscovery__threshold="100",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def dicts(df, key):
    """Rows as dicts by a key column."""
    return {r[key]: {k: v for k, v in r.asDict().items() if k != key} for r in df.collect()}
