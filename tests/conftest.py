import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from propensity.session import build_session
    s = build_session("local[4]", "propensity-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def ctr01(spark):
    from propensity.fixtures import ctr_frame
    return ctr_frame(spark, SF01).persist()


@pytest.fixture(scope="session")
def duck01():
    from oracle_harness import duck
    return duck(SF01)
