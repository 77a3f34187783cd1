import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from stationday.session import local_session

    yield local_session(4, "stationday-tests", "4g")


@pytest.fixture()
def tables(spark):
    from stationday.config import PipelineConfig
    from stationday.plans.stages import setup

    return setup(spark, PipelineConfig.fresh(spark, "test"))


@pytest.fixture()
def scratch(spark):
    from stationday.config import fresh_dir

    d = fresh_dir(spark, "test-scratch")
    return d.removeprefix("file:")
