"""Physical-plan properties every registered query must keep."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderlens.plans.registry import all_queries  # noqa: E402

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_joins_or_python_in_any_query(spark, sf):
    bad = {}
    for name, q in all_queries().items():
        plan = _plan(q(spark, sf))
        hits = [k for k in FORBIDDEN if k in plan]
        if hits:
            bad[name] = hits
    assert bad == {}


def test_top_k_per_user_is_pushed_below_the_shuffle(spark, sf):
    qs = all_queries()
    for name in ("recent_purchases_5", "spend_change_5", "recent_purchase"):
        plan = _plan(qs[name](spark, sf))
        assert "WindowGroupLimit" in plan and "Partial" in plan, name


def test_gold_scan_prunes_and_pushes_filters(spark, sf, tmp_path):
    from orderlens.operators import gold
    from orderlens.plans.registry_base import silver_lines
    from orderlens.sources import layers

    layers.write_layer(silver_lines(spark, sf), str(tmp_path), "order_items")
    lines = layers.read_layer(spark, str(tmp_path), "order_items")
    gold.order_rollup(lines).write.parquet(f"{tmp_path}/rollup")
    rollup = spark.read.parquet(f"{tmp_path}/rollup")
    plan = _plan(gold.conform(gold.customer_ltv_daily(rollup), "customer_ltv_daily"))
    assert "PushedFilters: [IsNotNull(USER_ID)]" in plan
    assert "ReadSchema: struct<ORDER_ID:string,USER_ID:string,ORDER_DATE:date,TOTAL_LINE_REVENUE:decimal(38,2)>" in plan


def test_building_a_query_runs_no_job(spark, sf):
    """Only the schema of the tables is read until an action comes."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    for name, q in all_queries().items():
        q(spark, sf)
    # reading a Parquet footer is a job of its own, one per table read
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("building")]
    stages = [tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds]
    assert all(s is None or s.numTasks <= 1 for s in stages)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
