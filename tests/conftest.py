from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ferry.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "ferry-tests")
    yield session
    for query in session.streams.active:  # a failed streaming test must not leave a query running
        query.stop()
    session.stop()


@pytest.fixture
def scratch(spark):
    """A fresh folder under the session's shared checkpoint folder."""
    from ferry.session import fresh_dir

    return fresh_dir(spark, "tests")
