"""The registered queries against their DuckDB formulations on sf0.001."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck
from conftest import SF_SMALL

from servicelens.plans.oracle import ORACLE
from servicelens.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert res["status"] == "match", res


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_registered_queries_include_the_library(spark):
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 1
    assert "wd_lead_time_avg" in df.columns


def test_no_python_udfs_in_plans(spark):
    for name in ["featured_parts", "association_rules", "demand_sequences", "parse_dates"]:
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_stage_filters_pushed_down(spark):
    plan = QUERIES["time_analysis"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "d_goods_out" in plan
