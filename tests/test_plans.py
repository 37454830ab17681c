"""What the physical plans of the registered queries may not hold."""

import pytest

import __spark_entry__ as entry_points
from railmart import catalog

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]


@pytest.mark.parametrize("name", sorted(catalog.all_queries()))
def test_no_cross_join_and_no_python(spark, name):
    plan = catalog.all_queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]


def test_every_query_has_sql():
    assert catalog.all_queries().keys() == catalog.all_sql().keys()
    assert entry_points.queries().keys() >= catalog.all_queries().keys()


def test_filters_and_columns_reach_the_scan(spark):
    df = catalog.all_queries()["orphan_check"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(c_acctbal,0.0)" in plan
    assert "o_totalprice" not in plan


def test_entry_runs(spark):
    df = entry_points.entry(spark)
    assert df.columns[:3] == ["origin", "destination", "vehicule_type"] and df.count() > 0


@pytest.mark.parametrize("name", ["overview", "keep_one_dedup"])
def test_co2_is_computed_only_where_it_is_read(spark, name):
    plan = catalog.all_queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "co2_kg" not in plan
