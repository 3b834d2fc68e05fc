"""Physical-plan properties of every registered query."""

import re

import pytest

from govframe.plans.recipes import RECIPES
from tests.conftest import SF_SMALL

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "FlatMapGroupsInPandas")


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, fn in RECIPES.items():
        out[name] = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    return out


def test_no_python_udfs_or_cartesian(plans):
    bad = {n: [f for f in FORBIDDEN if f in p] for n, p in plans.items()}
    assert {n: f for n, f in bad.items() if f} == {}


def test_no_nested_loop_joins(plans):
    # one-row guards and statuses are scalar subqueries, not cross joins
    assert {n for n, p in plans.items() if "BroadcastNestedLoopJoin" in p} == set()


def test_filters_and_columns_reach_the_scan(plans):
    p = plans["scan_projection"]
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(c_acctbal,0\.0\)", p)
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int,c_acctbal:double>" in p
    assert "PushedFilters: [IsNotNull(o_custkey), EqualTo(o_custkey,ScalarSubquery" in plans["scalar_lookup"]


def test_top_k_per_group_is_partial_before_shuffle(plans):
    p = plans["snapshot_history"]
    assert "WindowGroupLimit" in p


def test_rls_filter_reaches_the_scan(plans):
    # the principal's subject (a scalar subquery) is pushed into the Parquet scan of the protected table
    assert "EqualTo(c_custkey,ScalarSubquery" in plans["rls_session_filter"]
    assert "EqualTo(o_custkey,ScalarSubquery" in plans["rls_child_table"]


def test_no_table_goes_to_one_task(plans):
    """A single-partition exchange only collects partial aggregates, the best few rows of each task,
    the offsets of the numbering (a row per partition) or the checklist (a row per rule)."""
    offenders = set()
    for name, plan in plans.items():
        lines = plan.splitlines()
        for line, below in zip(lines, lines[1:]):
            if "Exchange SinglePartition" in line and not re.search(r"HashAggregate\(keys=\[\]|SortAggregate\(key=\[\]|LocalLimit|HashAggregate\(keys=\[_pid", below):
                offenders.add(name)
    assert offenders <= {"quality_checklist"}
