import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pressloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, 4)


@pytest.fixture(scope="session")
def small_dir():
    return "/root/testdata/sf0.001"
