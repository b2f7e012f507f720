"""Every bound query beside its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
from bindings.oracle import all_oracles
from bindings.queries import all_queries
from tests.oracle_check import connect, difference

FOLDER = "/root/testdata/sf0.01"
QUERIES, ORACLES = all_queries(), all_oracles()
# The boards of single metrics are parts of ``leaderboards``; the jobs have tests of their own.
COMPARED = [name for name in ORACLES if not name.startswith(("leaderboard_", "etl_initial"))]


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(QUERIES) - set(ORACLES) == {"sentiment_by_classifier"}
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", COMPARED)
def test_query_agrees_with_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, FOLDER), duck.sql(ORACLES[name])) is None


def test_queries_without_sql_keep_every_row(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    scored = QUERIES["sentiment_by_classifier"](spark, FOLDER)
    assert scored.count() == documents.count()
    assert {r.Sentiment for r in scored.select("Sentiment").distinct().collect()} <= {0, 1}
    summary = {r["summary"]: r["Score"] for r in QUERIES["summarize_posts"](spark, FOLDER).collect()}
    assert list(summary) == ["count", "mean", "stddev", "min", "25%", "50%", "75%", "max"]
    assert summary["min"] == 1.0 and summary["max"] == 50.0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
