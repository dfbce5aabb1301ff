import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = os.environ.get("TESSERA_TEST_SF", "/root/testdata/sf0.001")
SF_ORACLE = os.environ.get("TESSERA_ORACLE_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_spark, checkpoint_dir
    s = get_spark(master="local[*]", shuffle_partitions=8, conf={"spark.driver.memory": "8g"})
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture(scope="session")
def sf_oracle():
    return SF_ORACLE
