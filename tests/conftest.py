import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from lakeloom.registry import Tables  # noqa: E402
from lakeloom.session import local_session  # noqa: E402

SF = os.environ.get("LAKELOOM_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture(scope="session")
def t(spark):
    return Tables(spark, SF)


@pytest.fixture(scope="session")
def sf_dir():
    return SF
