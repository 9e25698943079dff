import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import build_session

    scratch = tempfile.mkdtemp(prefix="tidewater-tests-")
    s = build_session("local[4]", 8, app="tidewater-tests",
                      extra={"spark.checkpoint.dir": f"{scratch}/checkpoints",
                             "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SMOKE


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
