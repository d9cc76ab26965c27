import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark():
    from corpusq.session import local_session

    s = local_session(8, memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    return s
