"""Every registered query against its SQL, at the smallest scale."""

import os

import pytest

from compare import connect, difference
from karst.workload import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    if name in ORACLES:
        assert difference(spark, duck, QUERIES[name], ORACLES[name], SF) is None
    else:
        assert QUERIES[name](spark, SF).count() > 0


def test_contract():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
