import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    from tarmac.session import get_session
    s = get_session("local[4]", 4, extra={"spark.default.parallelism": "4", "spark.driver.memory": "2g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from compare import duckdb_conn
    from tables import SF01
    return duckdb_conn(SF01)
