"""Every registered query beside its SQL, on the smallest given tables."""

import os

import pytest

import __spark_entry__ as contract
from harness.oracles import ORACLES
from harness.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")


@pytest.fixture(scope="module")
def db():
    from harness.check import connect

    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys() and ORACLES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    from harness.check import compare

    assert compare(spark, db, name, SF_DIR) == ""


RANKED = ("top_n", "search_filter", "fresh_only", "search_any_column", "display_clean", "score_bands", "top_3",
          "kpi_summary", "kpi_avg_salary", "ranking_view", "filtered_top_3")


@pytest.mark.parametrize("name", RANKED)
def test_ranked_queries_read_the_stored_table(spark, name):
    """A Parquet scan with the threshold pushed down; no pattern of a feature, no Python."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(matching_score" in plan and "Python" not in plan and "terraform" not in plan
    assert plan.count("FileScan parquet") == 1


def test_entry(spark):
    assert contract.entry(spark).count() > 0
