import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lendstar.session import build_session
    s = build_session("local[4]", app="lendstar-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, tmp_path):
    """A fresh folder for files a test writes."""
    return str(tmp_path)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
