import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from skuflow.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=4, app_name="skuflow-tests")
    yield s


@pytest.fixture(scope="session")
def model(spark):
    """The sf0.001 model, loaded once into the session's checkpoint folder."""
    from skuflow.sources.tpch import bind
    return bind(spark, SF001)


@pytest.fixture(scope="session")
def lazy_model(spark):
    from skuflow.sources.tpch import bind
    return bind(spark, SF001, materialize=False)


@pytest.fixture(scope="session")
def built(spark):
    """A registered query's result at sf0.001, built once for all tests that look at it."""
    from skuflow import registry
    made = {}

    def get(key):
        if key not in made:
            made[key] = registry.queries()[key](spark, SF001)
        return made[key]

    return get
