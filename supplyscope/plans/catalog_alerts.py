"""Registered queries, part 3: alert rule jobs and conflicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from supplyscope.operators import alerts, conflicts, tables
from supplyscope.plans.catalog import feats, inventory, weekly
from supplyscope.plans.catalog_models import all_preds
from supplyscope.plans.context import run_for
from supplyscope.plans.registry import register
from supplyscope.plans.sqlparts import with_
from supplyscope.plans.sqlparts_alerts import ALERT_ID, ALERTS, RUN_TS

A_COLS = ("id, created_at, agent, severity, category, product_name, order_id, message, "
          "recommendation, is_resolved, action, direction")


def fraud(spark, d):
    return alerts.fraud_alerts(feats(spark, d), RUN_TS)


# The agents that read predictions take every input from the same run, so
# the order lines come from the run's stored table (one scan + semi-join).
def delivery(spark, d):
    run = run_for(spark, d)
    return alerts.delivery_alerts(run.preds, run.feats, RUN_TS)


def inventory_a(spark, d):
    run = run_for(spark, d)
    return alerts.inventory_alerts(run.preds, run.inventory, RUN_TS)


def demand(spark, d):
    run = run_for(spark, d)
    return alerts.demand_alerts(run.preds, run.baseline, RUN_TS)


def agent_alerts(spark, d):
    """SET5: the agents' frames united (checkpointed once per run)."""
    return run_for(spark, d).agent_alerts


def conflict_alerts(spark, d):
    return run_for(spark, d).conflict_alerts


def all_alerts(spark, d):
    return run_for(spark, d).all_alerts


@register("top1_fraud_orders", with_(ALERTS) + """
SELECT order_id, order_date, product_name, customer_segment, market, order_region, sales, delivery_status, delay_days
FROM fraud_top""")
def q_top1(spark, d):
    """TOP1 + FLT1: fraud lines by sales desc, first 500."""
    return alerts.top_fraud_orders(run_for(spark, d).feats, 500).select(
        "order_id", "order_date", "product_name", "customer_segment", "market", "order_region",
        "sales", "delivery_status", "delay_days")


@register("agt1_fraud_alerts", with_(ALERTS) + f"\nSELECT {A_COLS} FROM agent_alerts WHERE agent = 'FraudAgent'")
def q_agt1(spark, d):
    return fraud(spark, d)


@register("top2_late_predictions", with_(ALERTS) + "\nSELECT order_id, prob FROM dtop")
def q_top2(spark, d):
    """TOP2 + FLT2: the 200 highest late-delivery scores."""
    return alerts.top_late_predictions(all_preds(spark, d), 200).select(
        "order_id", F.col("predicted_value").alias("prob"))


@register("jon3_win5_order_context", with_(ALERTS) + """
SELECT order_id, product_name, shipping_mode, market, order_region, customer_segment, sales, department, days_scheduled FROM ctx""")
def q_jon3(spark, d):
    """JON3 + WIN5: last line of each order with a late prediction."""
    run = run_for(spark, d)
    return alerts.order_context(run.feats, alerts.late_orders(run.preds))


@register("agt2_delivery_alerts", with_(ALERTS) + f"\nSELECT {A_COLS} FROM agent_alerts WHERE agent = 'DeliveryAgent'")
def q_agt2(spark, d):
    return delivery(spark, d)


@register("agt3_agt4_inventory_alerts", with_(ALERTS) + f"\nSELECT {A_COLS} FROM agent_alerts WHERE agent = 'InventoryAgent'")
def q_agt3(spark, d):
    """AGT3 + AGT4 + JON4 + FLT11."""
    return inventory_a(spark, d)


@register("agt4_reorder_quantity", with_(ALERTS) + """
SELECT product_name, plabel AS label, qty,
       CAST(CAST(qty AS DECIMAL(20,0)) * CAST(coalesce(product_price, 0.0) AS DECIMAL(20,2)) AS DOUBLE) AS cost
FROM ij""")
def q_agt4(spark, d):
    p = all_preds(spark, d).where("prediction_type = 'inventory' AND label <> 'safe'")
    j = p.select("product_name", "label").join(inventory(spark, d), "product_name", "left")
    qty = alerts.reorder_quantity(F.col("avg_daily_demand"), F.col("simulated_stock"), F.col("label"))
    return j.select("product_name", "label", qty.alias("qty"),
                    (qty.cast("decimal(20,0)") * F.coalesce("product_price", F.lit(0.0)).cast("decimal(20,2)"))
                    .cast("double").alias("cost"))


@register("agt5_demand_alerts", with_(ALERTS) + f"\nSELECT {A_COLS} FROM agent_alerts WHERE agent = 'DemandAgent'")
def q_agt5(spark, d):
    """AGT5 + JON1 + JON5 + FLT12."""
    return demand(spark, d)


@register("agg19_demand_outcomes", with_(ALERTS) + "\nSELECT outcome, count(*) AS n FROM outc GROUP BY outcome")
def q_agg19d(spark, d):
    return alerts.demand_outcome_counts(all_preds(spark, d), tables.demand_baseline(weekly(spark, d)))


@register("agg19_severity_counts", with_(ALERTS) + "\nSELECT agent, severity, count(*) AS n FROM agent_alerts GROUP BY agent, severity")
def q_agg19(spark, d):
    return alerts.severity_counts(agent_alerts(spark, d))


@register("set5_agent_alerts", with_(ALERTS) + f"\nSELECT {A_COLS} FROM agent_alerts")
def q_set5(spark, d):
    """SET5: the four agents' alerts united, over the run's stored lines."""
    return (alerts.fraud_alerts(run_for(spark, d).feats, RUN_TS).unionByName(delivery(spark, d)).unionByName(inventory_a(spark, d))
            .unionByName(demand(spark, d)))
