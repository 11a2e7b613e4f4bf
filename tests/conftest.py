import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from amperine.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # a folder of its own, so that tests leave nothing behind in a shared one
    folder = tmp_path_factory.mktemp("shared")
    session = build_session(
        4, "tests", **{"spark.checkpoint.dir": str(folder), "spark.sql.shuffle.partitions": "4",
                       "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
