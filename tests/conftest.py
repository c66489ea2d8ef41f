import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tallyhouse.session import local_session  # noqa: E402

TESTDATA = os.environ.get("TALLYHOUSE_TESTDATA", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus=8, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    if not Path(TESTDATA).is_dir():
        pytest.skip("test tables not present")
    return TESTDATA
