"""Every corpus query that SQL can express beside its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
from tagloom.llm.oracle import llm_oracles
from tagloom.llm.queries import llm_queries
from tests.oracle_check import connect, difference

FOLDER = "/root/testdata/sf0.01"


def test_every_corpus_query_is_bound():
    assert {*llm_queries(), "pipeline"} <= set(entry.queries())
    assert set(llm_oracles()) <= set(llm_queries()) and set(llm_oracles()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", llm_oracles())
def test_query_agrees_with_sql(spark, name):
    assert difference(llm_queries()[name](spark, FOLDER), connect(FOLDER).sql(llm_oracles()[name])) is None
