import os
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

import pytest  # noqa: E402

from siltline.session import session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("tests", cores="4", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()


DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def data():
    return DATA
