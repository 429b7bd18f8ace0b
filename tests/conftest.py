import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vigilog.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark_sql_shuffle_partitions="4", spark_driver_memory="4g", spark_ui_showConsoleProgress="false"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
