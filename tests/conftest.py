import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app="tessera-tests")
    yield s
    s.stop()


@pytest.fixture()
def skew_low(spark):
    """Make every group with >= 3 rows 'hot' so the salted paths run."""
    keys = ["spark.tessera.skew.minRows", "spark.tessera.skew.salts"]
    old = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set("spark.tessera.skew.minRows", "3")
    spark.conf.set("spark.tessera.skew.salts", "4")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)
