import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from tallyroute.session import local_session  # noqa: E402

# Columns can only be built while a session is up, so it starts before the tests are collected.
SESSION = local_session("tests", cpus=8, memory="8g")
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()
