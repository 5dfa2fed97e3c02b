import os

import pytest

from seriesforge.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4, memory="8g")
    # The SQL twins of model queries hold at any size; TEST_MODELS=production fits the catalogue's own.
    session.conf.set("spark.seriesforge.models", os.environ.get("TEST_MODELS", "small"))
    yield session
    session.stop()
