"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from rankflow.session import scratch

FOLDER = "/root/testdata/sf0.001"
OPTIONAL = set(contract._training_text()[0])  # tested in their own folder
QUERIES = {name: query for name, query in contract.queries().items() if name not in OPTIONAL}
BRUTE_FORCE = {"text_ranker_metrics", "stepwise_ranker"}
"""Queries that SQL cannot express; each has a test against a plain computation."""
SQL = {name: text for name, text in contract.oracle_sql().items() if name not in OPTIONAL}


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL) | BRUTE_FORCE


def test_entry(spark):
    systems = [r.system for r in contract.entry(spark).collect()]
    assert len(systems) == 8


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    with scratch(spark):
        frame = QUERIES[name](spark, FOLDER).toPandas()
    assert len(frame), "a query without rows proves nothing"
    if name in SQL:
        assert difference(frame, connection.execute(SQL[name]).df()) is None
