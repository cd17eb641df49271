import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def _folder(*parts):
    path = os.path.join(*parts)
    os.makedirs(path, exist_ok=True)
    return path


@pytest.fixture(scope="session")
def spark():
    from tillwise.session import build_session

    scratch = tempfile.mkdtemp(prefix="tillwise-tests-")
    s = build_session("local[4]", app="tillwise-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                             "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
                             "spark.driver.memory": "4g",
                             # read by tests that count what a query scans
                             "spark.eventLog.enabled": "true",
                             "spark.eventLog.dir": _folder(scratch, "events"),
                             "spark.eventLog.compress": "false",
                             "spark.eventLog.rolling.enabled": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from parity import duck_connection
    return duck_connection(SMALL)
