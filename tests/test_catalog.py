"""Every registered query against its SQL; those without SQL run and keep their schema."""

import pytest

from docketeer.plans import document_queries, event_queries, field_queries, harvest_queries, ruling_queries, stream_queries, table_queries  # noqa: F401
from docketeer.plans.registry import ORACLE_SQL, QUERIES
from tests.conftest import DATA


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(name, same_rows):
    same_rows(QUERIES[name], ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_runs(name, spark):
    df = QUERIES[name](spark, DATA)
    assert df.count() > 0 and df.columns


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
