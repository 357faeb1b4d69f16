"""Physical plans of the registered queries."""

import pytest

import __spark_entry__ as entry_points
from casebook.plans import checks


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark, small):
    return {name: plan_of(query(spark, small)) for name, query in entry_points.queries().items()}


def test_no_row_passes_through_python(plans):
    for name, plan in plans.items():
        for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"):
            assert node not in plan, name


def test_no_cross_joins(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_single_pass_aggregates_shuffle_once(plans):
    for name in ("count_by_category", "rate_by_type", "yearly_trends"):
        assert plans[name].count("Exchange hashpartitioning") == 1
        assert plans[name].index("partial_count") > plans[name].index("Exchange hashpartitioning")


def test_aggregates_join_without_another_shuffle(plans):
    """Each side of the outer join is shuffled for its aggregate and not again for the join."""
    assert plans["district_rates"].count("Exchange") == 2


def test_scans_read_only_what_is_used(plans):
    assert "ReadSchema: struct<o_orderstatus:string,o_orderdate:timestamp_ntz>" in plans["yearly_trends"]
    assert "ReadSchema: struct<l_returnflag:string>" in plans["count_by_category"]
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in plans["rate_by_joined_category"]


def test_dimensions_are_broadcast(plans):
    for name in ("join_facts_dimension", "station_distance"):
        assert "BroadcastHashJoin" in plans[name] and "LeftOuter, BuildRight" in plans[name]


def test_top_rows_need_no_full_sort(plans):
    assert "TakeOrderedAndProject" in plans["top_preview"]


def test_shuffle_joins_follow_size(spark, small):
    """Without a small side the fact joins are sort-merge joins on one shuffle per side."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(checks.join_facts_events(spark, small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 2


def test_whole_stage_codegen(spark, small):
    df = checks.rate_by_district(spark, small)
    df.collect()
    assert "*(1) HashAggregate" in plan_of(df)
