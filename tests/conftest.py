import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cellwatch.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build("tests", "local[4]", spark_ui_enabled="false", spark_sql_shuffle_partitions="4",
                    spark_driver_memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
