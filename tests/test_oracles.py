"""Every registered query against its SQL on the smallest tables."""

import pytest

from ledgerloom.plans import catalog
from tests.oracle import connect, same

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.load()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    same(QUERIES[name](spark, SF), con, SQL[name])


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
