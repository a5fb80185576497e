import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from gatewright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cpus=4, memory="6g", spark__sql__shuffle__partitions="2")
