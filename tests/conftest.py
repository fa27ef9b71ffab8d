import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from siftlane.runtime import session

    s = session("tests", "4")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("no test tables here")
    return str(path)
