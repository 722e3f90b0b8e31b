import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    session = build_session("tests", "local[8]", 8)
    session.sparkContext.setLogLevel("ERROR")
    return session


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF
