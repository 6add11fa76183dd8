from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidecast.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


def rows(df, *columns):
    """Rows as sorted tuples, with nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(r) for r in picked.collect()),
        key=lambda r: tuple((v is not None, v) for v in r),
    )
