import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark():
    from folioforge.session import local_session, ship

    return ship(local_session(4, "6g"))
