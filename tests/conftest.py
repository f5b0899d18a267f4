import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from orderloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests")
