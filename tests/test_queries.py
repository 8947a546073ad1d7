"""Every query of the library beside the training-data operators: its SQL agrees, or it gives rows."""

from __future__ import annotations

import pytest
from oracle import connection, same

from tidemark.plans import audit_queries, corpus_queries, kernel_queries, panel_queries

PLANS = [panel_queries, corpus_queries, kernel_queries, audit_queries]
QUERIES = {n: q for p in PLANS for n, q in p.QUERIES.items()}
SQL = {n: q for p in PLANS for n, q in p.ORACLE_SQL.items()}


@pytest.fixture(scope="module")
def con(sf):
    return connection(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf, con, name):
    same(QUERIES[name](spark, sf), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert len(df.columns) == len(set(df.columns))
    df.collect()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 10
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
