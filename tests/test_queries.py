"""Every registered query against its SQL twin on the small tables."""

import pytest

import __spark_entry__ as registry
from oracle import connect, mismatch

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_of_the_library_has_a_twin():
    ours = {n for module in registry._MODULES[:4] for n in module.QUERIES}
    assert ours <= registry.oracle_sql().keys() <= registry.queries().keys()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, con, name):
    assert mismatch(registry.queries()[name](spark, SF_DIR), con, registry.oracle_sql()[name]) is None


def test_entry(spark):
    ranks = registry.entry(spark)
    assert ranks.columns == ["node", "rank"]
    assert ranks.count() == 15
