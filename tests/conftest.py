from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starmart.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "starmart-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples of the given columns (all if none)."""

    def read(df, *columns):
        got = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(got, key=lambda r: tuple((v is None, str(v)) for v in r))

    return read
