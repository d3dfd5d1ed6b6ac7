from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from headway.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return build_session("tests", 4, spark__sql__shuffle__partitions="4")


@pytest.fixture()
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def get(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return get
