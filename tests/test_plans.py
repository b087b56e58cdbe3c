"""Plan guards for the scale design, on executed (final adaptive) plans: no
cross product, pruned scans, and no shuffle of order lines on a few-valued
key."""

import re

import pytest

from supplyscope.plans import load_all

SKIP = {"mld1_mld2_delivery_forest", "mld1_agg24_forest_held_out", "mld3_win6_feature_importance"}  # MLlib plans
FEW_VALUED = "shipping_mode|market|customer_segment|department|order_status|late_delivery_risk"


def final_plan(df) -> str:
    """The plan that ran: ``collect`` uses the frame's own execution."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan or "AdaptiveSparkPlan" not in plan
    return plan


def test_no_cross_products(spark, sf_small):
    bad = []
    for name, fn in load_all().QUERIES.items():
        if name in SKIP:
            continue
        plan = fn(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
            bad.append(name)
    assert bad == []


def test_order_line_scan_is_pruned(spark, sf_small):
    plan = final_plan(load_all().QUERIES["agg9_revenue_by_market"](spark, sf_small))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double>" in plan
    assert "l_comment" not in plan and "l_tax" not in plan


@pytest.mark.parametrize("name", ["mld2_delivery_predictions_rule", "agg16_risk_histogram", "agg24_confusion",
                                  "prj19_apply_codes", "agt2_delivery_alerts", "smp2_stratified_sample"])
def test_lines_are_not_shuffled_on_few_values(spark, sf_small, name):
    """An exchange on few-valued keys alone carries partial aggregates only."""
    lines = final_plan(load_all().QUERIES[name](spark, sf_small)).split("\n")
    for above, below in zip(lines, lines[1:], strict=False):
        keys = re.search(r"Exchange hashpartitioning\(([^)]*)\)", above)
        if keys and all(re.match(FEW_VALUED, k.strip()) for k in keys[1].split(",")[:-1]):
            assert re.search(r"Aggregate|WindowGroupLimit|Sort|Project", below), (above, below)
            if "smp2" not in name:
                assert "Aggregate" in below, (above, below)


TABLES_READ = 6  # a footer job for each parquet table that the lines come from


@pytest.mark.parametrize("name", ["agg1_inventory", "agg2_span_days", "agg3_weekly_demand", "agg9_revenue_by_market", "agg16_risk_histogram",
                                  "mld2_delivery_predictions_rule", "mld4b_demand_forecast", "mld4_seasonal_forecast", "prj17_18_scaling"])
def test_building_runs_no_job(spark, sf_small, name):
    """Queries that don't select the high-value flag fit nothing while built."""
    from supplyscope.plans import context
    context._RUNS.clear()
    spark.sparkContext.setJobGroup(f"build-{name}", name)
    load_all().QUERIES[name](spark, sf_small)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")
    spark.sparkContext.setJobGroup("tests", "tests")
    assert len(jobs) <= TABLES_READ
