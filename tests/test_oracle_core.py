import pytest
from oracle import connect, same_rows

from tracemill.plans import catalog


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_as_sql(spark, small, con, name):
    same_rows(catalog.queries()[name](spark, small), con, catalog.oracle_sql()[name])
