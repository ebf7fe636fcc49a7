"""Every registered query against its SQL, by value."""

import pytest

from __spark_entry__ import entry
from ebbline.catalog.oracle import ORACLE_SQL
from ebbline.catalog.queries import QUERIES
from tests.compare import compare, connect

# Fixed value: the queries whose result SQL cannot state (fitted models).
WITHOUT_SQL = {"quantile_forecast", "score_forecast"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], sf_dir) == []


def test_every_query_has_sql_but_the_fitted_ones():
    assert set(QUERIES) - set(ORACLE_SQL) == WITHOUT_SQL
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_no_cross_join_in_any_plan(spark, sf_dir):
    for name in sorted(set(QUERIES) - WITHOUT_SQL - {"boost_invariants"}):  # fits a model to plan one aggregation
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_repeated_keys_are_limited_before_the_shuffle(spark, sf_dir):
    plan = QUERIES["dedup_latest"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
