"""Every query of the package over empty tables, tables of nulls, and repeated rows with clashing columns."""

import pytest

from tracemill.llm import queries

QUERIES = queries.queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs_on_empty_tables(spark, empty_tables, name):
    rows = QUERIES[name](spark, empty_tables).collect()
    assert rows == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs_on_nulls(spark, null_tables, name):
    rows = QUERIES[name](spark, null_tables).collect()
    assert not name.endswith("_found") or rows == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs_on_odd_tables(spark, odd_tables, name):
    QUERIES[name](spark, odd_tables).collect()
