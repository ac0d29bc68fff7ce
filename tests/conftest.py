import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemill.session import build_session

    s = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__default__parallelism="4")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
