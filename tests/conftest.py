from __future__ import annotations

import pytest

from tagwright.session import local_session
from tests.star import Star


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    yield session
    session.stop()


@pytest.fixture()
def star(spark):
    return Star(spark)
