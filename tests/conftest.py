from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
TESTDATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from grainmill.session import clean, local_session

    s = local_session("tests", cpus=8, memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    yield s
    clean(s)
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(TESTDATA).exists():
        pytest.skip("no test tables here")
    return TESTDATA
