"""Properties of the physical plans that matter at scale."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from trustgate.checks import binding
from trustgate.checks.queries import QUERIES
from trustgate.sources import tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    """Plan as if no side were small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_python(name, large):
    plan = plan_of(QUERIES[name](large, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEval"):
        assert operator not in plan


def test_both_runs_share_one_scan_of_each_table(large):
    df = entry.queries()["scorecard"](large, SF)
    df.collect()
    final = plan_of(df).split("Initial Plan")[0]
    assert final.count("FileScan parquet") == 2
    assert final.count("ReusedExchange") == 2


def test_one_scan_serves_rules_and_aggregate_metrics(large):
    plan = plan_of(entry.queries()["validation_result"](large, SF))
    assert plan.count("FileScan parquet") == 2
    assert plan.count("SortMergeJoin") == 1


def test_sample_limits_groups_before_the_shuffle(large):
    plan = plan_of(entry.queries()["stratified_sample"](large, SF))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(dq_run_id")
    assert "Partial" in plan[plan.index("Exchange hashpartitioning(dq_run_id") :]


def test_scans_read_only_needed_columns(large):
    plan = plan_of(entry.queries()["kpi_hourly_avg"](large, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_keys_are_shuffled_as_digests_without_counters(large):
    """The shuffle of distinct keys holds two hashes, what rows are counted by, and one count."""
    for name in ("validation_result", "aggregate_rules"):
        plan = plan_of(entry.queries()[name](large, SF))
        (partial,) = [
            line
            for line in plan.splitlines()
            if "HashAggregate(keys=[_ok" in line and "_key1" in line and "partial_" in line
        ]
        functions = partial.partition("functions=[")[2]
        assert functions.startswith("partial_count(1)") and functions.count("partial_") == 1
        assert "vendor_id" not in partial and "taxi_type" not in partial


def test_only_needed_values_cross_the_join(large):
    """What a line alone decides is worked out before the shuffle, not from its raw columns."""
    plan = plan_of(binding.trips(large, SF).drop("trip_id"))
    below = plan.partition("SortMergeJoin")[2]
    (shuffled,) = [line for line in below.splitlines() if "Exchange hashpartitioning(l_orderkey" in line]
    crossing = below.partition(shuffled)[2].splitlines()[1]
    assert "Project [l_orderkey" in crossing and "l_shipdate" in crossing
    passed = {c.split(" AS ")[-1].split("#")[0].strip() for c in crossing.split(", ")}
    assert not {"l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus"} & passed


@pytest.mark.parametrize(
    "name, writer", [("rerun_facts", "replace_facts"), ("governance_append", "append_facts")]
)
def test_facts_of_several_runs_come_from_one_join(name, writer, large, monkeypatch):
    """Each run's facts are read back from one job's result; none joins the tables again."""
    plans, write = [], getattr(tables, writer)

    def recorded(facts, *rest):
        plans.append(plan_of(facts))
        return write(facts, *rest)

    monkeypatch.setattr(tables, writer, recorded)
    QUERIES[name](large, SF)
    assert len(plans) > 1
    assert not [p for p in plans if "Join" in p]


@pytest.mark.parametrize("name", ["layer_counts", "quarantine_pct"])
def test_counts_read_one_written_join(name, large):
    """Readers with filters of their own can't share a shuffle, so they share its result."""
    plan = plan_of(QUERIES[name](large, SF))
    assert "Join" not in plan and "l_orderkey" not in plan
