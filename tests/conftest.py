from __future__ import annotations

import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from trendlake.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
NOON = datetime(2024, 3, 1, 12, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    return local_session(4)


@pytest.fixture
def noon():
    return NOON


@pytest.fixture
def plan():
    def text(df):
        return df._jdf.queryExecution().toString()

    return text


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)
