import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from carelens.session import get_session

    s = get_session("local[*]", app_name="carelens-tests", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def small_sources(spark):
    from carelens.sources.fixtures import fixture_sources

    return fixture_sources(spark, SF_SMALL)


@pytest.fixture(scope="session")
def small_features(spark, small_sources):
    from carelens.config import FeatureConfig
    from carelens.plans.features import build_features

    return build_features(small_sources, FeatureConfig()).toPandas()
