"""One local session for all tests, with its own shared folder."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gildstar.session import build_session

    session = build_session(
        "gildstar-tests",
        "local[8]",
        spark__sql__shuffle__partitions=8,
        spark__driver__memory="6g",
        spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def rows():
    """Sorted tuples of a DataFrame, for comparing results without an order."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))

    return collect
