"""Plan-shape checks: what the scale design promises, read from the plans."""

import os
import tempfile

import pytest

from daybook.catalog import registered
from daybook import catalog as cat
from daybook.functions.measures import REVENUE_MEASURES
from daybook.plans.revenue import RevenueSources, run_revenue
from daybook.sources.feeds import read_partitions
from daybook.sources.fixtures import fixture

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registered()))
def test_no_cross_join_nested_loop_or_python(spark, sf_dir, name):
    if name == "stage_audit_counts":
        pytest.skip("returns the audit rows of an executed run")
    plan = plan_of(registered()[name](spark, sf_dir))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_revenue_job_pushes_window_and_prunes_history(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # untruncated scan metadata
    root = tempfile.mkdtemp(prefix="daybook-plan-")
    feeds = {}
    for n in ("hierarchy", "daily_actual", "daily_plan"):
        feeds[n] = os.path.join(root, n)
        fixture(spark, sf_dir, n).write.parquet(feeds[n])
    target = os.path.join(root, "target")
    cat.revenue_history(spark, sf_dir).selectExpr("CENTER", "PERIOD", *REVENUE_MEASURES) \
        .write.partitionBy("PERIOD").parquet(target)
    c = cat.clock()
    r = spark.read.parquet
    src = RevenueSources(hierarchy=r(feeds["hierarchy"]), actual=r(feeds["daily_actual"]),
                         plan=r(feeds["daily_plan"]), history=r(target))
    plan = plan_of(run_revenue(src, c, cat.FIXTURE_PARAMS))
    # window bounds reach the feed scans as pushed filters on the raw key
    assert f"GreaterThanOrEqual(PERIOD,{c.start_id})" in plan
    assert f"LessThanOrEqual(PERIOD,{c.end_id})" in plan
    assert f"LessThanOrEqual(PERIOD,{c.plan_end_id})" in plan
    # the target is read on the two last-year ranges only (partition pruning)
    lo1, hi1 = c.last_year_ranges()[0]
    assert "PartitionFilters: [" in plan and f"PERIOD" in plan and str(lo1) in plan and str(hi1) in plan
    # every aggregation is partial + final (map-side combine absorbs a hot center)
    assert plan.count("partial_sum") >= 2
    # the reader that lists only the table root yields the same plan inputs
    pruned = read_partitions(spark, target, c.last_year_ranges())
    periods = {row.PERIOD for row in pruned.select("PERIOD").distinct().collect()}
    assert periods and all(any(lo <= p <= hi for lo, hi in c.last_year_ranges()) for p in periods)


def test_ops_merge_is_one_aggregation_not_a_join_chain(spark, sf_dir):
    from daybook.plans import ops_goals as og
    root = tempfile.mkdtemp(prefix="daybook-plan-")
    fixture(spark, sf_dir, "hierarchy").write.parquet(os.path.join(root, "hierarchy"))
    src = cat.ops_sources(spark, sf_dir)
    src.hierarchy = spark.read.parquet(os.path.join(root, "hierarchy"))  # the recipe itself joins nation/region
    plan = plan_of(og.run_ops_goals(src, cat.clock(), cat.FIXTURE_ACCOUNTS, cast_to=cat.TEXT_CAST))
    # spine join + last-year join + the goals full outer join; nothing per component
    joins = plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") + plan.count("ShuffledHashJoin")
    assert joins <= 4, joins
    assert "FullOuter" in plan


def counts(plan: str) -> tuple[int, int, int]:
    return plan.count("Exchange hashpartitioning"), plan.count("SortAggregate"), plan.count("FileScan parquet")


def test_snapshot_merge_stays_hash_aggregated(spark, sf_dir):
    exchanges, sort_aggregates, _ = counts(plan_of(registered()["metric_merge_12way"](spark, sf_dir)))
    assert exchanges <= 20 and sort_aggregates == 0
    for name in ("newest_sums_day_account", "goal_pivot_cutoff"):
        assert counts(plan_of(registered()[name](spark, sf_dir)))[:2] == (2, 0)


def test_dda_feed_is_read_once(spark, sf_dir, tmp_path):
    from daybook.plans import ops_goals as og
    fixture(spark, sf_dir, "account_feed").write.parquet(str(tmp_path / "acct"))
    df = og.dda_feed_component(spark.read.parquet(str(tmp_path / "acct")), 20000201, 20000314, cat.FIXTURE_ACCOUNTS)
    assert counts(plan_of(df)) == (2, 0, 1)


def test_no_round_robin_under_the_queries(spark, sf_dir):
    for name in ("fact_center_filter", "daily_actual_measures", "text_metric_sums", "staffing_hours", "buyback_rollup"):
        assert "RoundRobin" not in plan_of(registered()[name](spark, sf_dir))
