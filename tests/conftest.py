import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from catalogloom.session import build_session
    session = build_session("local[8]", "tests", spark_sql_shuffle_partitions=8, spark_driver_memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
