"""Every registered query against its SQL on the test tables."""

import pytest
from compare import connect, difference

from rowferry.checks.registry import all_oracles, all_queries


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_agrees_with_sql(spark, sf, con, name):
    df = all_queries()[name](spark, sf)
    sql = all_oracles().get(name)
    if sql is None:
        assert df.count() > 0
        return
    assert difference(df, con, sql) is None


def test_every_query_has_sql():
    assert set(all_oracles()) == set(all_queries())


def test_entry_has_rows(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert contract.queries().keys() >= contract.oracle_sql().keys() >= all_oracles().keys()
    assert contract.queries().keys() >= all_queries().keys()
