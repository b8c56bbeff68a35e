import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # the checkpoint folder comes from the session (spark.checkpoint.dir); local_session only
    # creates a scratch one when none is configured
    s = local_session("*", 8, app="stockflow-tests")
    yield s
    s.stop()


@pytest.fixture()
def small_chunks(spark):
    """Chunks of a few rows, so that every key spans many of them."""
    spark.conf.set("stockflow.chunkRows", "7")
    yield
    spark.conf.unset("stockflow.chunkRows")
