"""Every core query over empty tables, tables of nulls, and repeated rows with clashing columns."""

import pytest

from tracemill.plans import catalog

QUERIES = catalog.queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs_on_empty_tables(spark, empty_tables, name):
    QUERIES[name](spark, empty_tables).collect()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs_on_nulls(spark, null_tables, name):
    QUERIES[name](spark, null_tables).collect()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs_on_odd_tables(spark, odd_tables, name):
    QUERIES[name](spark, odd_tables).collect()
