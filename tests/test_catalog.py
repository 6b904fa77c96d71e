"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest
from harness import compare, duck

import __spark_entry__ as entry

FOLDER = os.environ.get("SF", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL[name], FOLDER) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["source", "documents", "changed_documents", "pii_count"] and df.count() > 0


def test_plans_have_no_cross_join(spark):
    for name in ("f2_pii_report", "j2_score_lm", "j4_trial_sweep", "c8_contextual_insertion", "f7_check_licenses", "a3_resolve_splits"):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
