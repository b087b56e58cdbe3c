"""Cross-alert conflict job and manager briefing (AGT6-9, JON10, SET4,
WIN4, TOP10, PRJ25).

The reference groups alerts into per-product and per-order lists in
Python.  Here each is one ``groupBy`` with conditional aggregates: a
category-presence flag per category (``bool_or``), the newest alert of a
category as ``max`` of a (created_at, -id, value) struct, and sorted sets.
A hot product or order only costs a partial aggregate per task (map-side
combine), never a list in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope.functions.columns import severity_rank, truncate_text
from supplyscope.operators.alerts import facts, finish


def open_alerts(alerts: DataFrame, limit: int | None = None) -> DataFrame:
    """AGT9 input: open alerts, newest first; earlier conflict alerts are
    left out so a rerun does not feed on its own output.  ``limit`` keeps
    only the newest n (the reference reads 2,000)."""
    a = alerts.where((F.col("is_resolved") == 0) & (F.col("category") != "conflict"))
    if limit is not None:
        a = a.orderBy(F.col("created_at").desc(), F.col("id").asc()).limit(limit)
    return a


def _newest(cat: str, value) -> F.Column:
    return F.max(F.when(F.col("category") == cat,
                        F.struct(F.col("created_at"), (-F.col("id")).alias("nid"), value.alias("v"))))


def product_conflicts(alerts: DataFrame, run_ts: str) -> DataFrame:
    """AGT6 (inventory vs declining demand) and AGT7 (delivery + inventory,
    no fraud) per product."""
    a = alerts.where(F.col("product_name").isNotNull() & (F.col("product_name") != ""))
    g = a.groupBy("product_name").agg(
        F.bool_or(F.col("category") == "inventory").alias("has_inv"),
        F.bool_or(F.col("category") == "demand").alias("has_dem"),
        F.bool_or(F.col("category") == "delivery").alias("has_del"),
        F.bool_or(F.col("category") == "fraud").alias("has_fraud"),
        _newest("inventory", F.col("severity")).alias("inv"),
        _newest("demand", F.col("direction")).alias("dem"),
    )
    name = F.col("product_name")
    inv_sev = F.coalesce(F.col("inv.v"), F.lit("HIGH"))
    strong = severity_rank(inv_sev) >= 3
    c6 = g.where(F.col("has_inv") & F.col("has_dem") & (F.col("dem.v") == "decline")).select(
        "product_name", F.when(strong, "HIGH").otherwise("MEDIUM").alias("severity"),
        facts(product=name, rule=F.lit("restock_against_decline"), inventory=inv_sev).alias("message"),
        F.when(strong, "partial_reorder").otherwise("defer").alias("action"))
    c7 = g.where(F.col("has_del") & F.col("has_inv") & ~F.col("has_fraud")).select(
        "product_name", F.lit("HIGH").alias("severity"),
        facts(product=name, rule=F.lit("late_and_short")).alias("message"), F.lit("compound").alias("action"))
    out = c6.unionByName(c7).withColumn("recommendation", facts(action=F.col("action"), product=name))
    return finish(out, "ConflictResolver", "conflict", run_ts, ["action", "product_name", "order_id"])


def order_escalations(alerts: DataFrame, run_ts: str) -> DataFrame:
    """AGT8 + SET4: an order flagged by fraud and any other category ->
    CRITICAL, listing the other agents and categories (sorted)."""
    a = alerts.where(F.col("order_id").isNotNull())
    g = a.groupBy("order_id").agg(
        F.collect_set("category").alias("cats"),
        F.collect_set(F.when(F.col("category") != "fraud", F.col("agent"))).alias("others"))
    g = g.where(F.array_contains("cats", "fraud") & (F.size("cats") > 1))
    other_cats = F.array_join(F.array_sort(F.array_except("cats", F.array(F.lit("fraud")))), ", ")
    other_agents = F.array_join(F.array_sort("others"), ", ")
    out = g.select(
        "order_id", F.lit("CRITICAL").alias("severity"),
        facts(order=F.col("order_id"), rule=F.lit("fraud_and_others"), agents=other_agents,
              categories=other_cats).alias("message"),
        facts(action=F.lit("block"), order=F.col("order_id")).alias("recommendation"),
        F.lit("block").alias("action"))
    return finish(out, "ConflictResolver", "conflict", run_ts, ["action", "product_name", "order_id"])


def resolve_conflicts(alerts: DataFrame, run_ts: str, limit: int | None = None) -> DataFrame:
    """AGT9: open alerts in, conflict alerts out (AGT6 + AGT7 + AGT8)."""
    a = open_alerts(alerts, limit)
    return product_conflicts(a, run_ts).unionByName(order_escalations(a, run_ts))


def briefing(alerts: DataFrame, n: int = 5) -> DataFrame:
    """TOP10: CRITICAL first, then HIGH, newest first within a tier, first
    n; issue / action text cut to 200 characters."""
    tier = F.when(F.col("severity") == "CRITICAL", 0).when(F.col("severity") == "HIGH", 1)
    top = (alerts.where((F.col("is_resolved") == 0) & tier.isNotNull())
           .withColumn("_tier", tier)
           .orderBy("_tier", F.col("created_at").desc(), F.col("id").asc()).limit(n))
    return top.select(
        "id", "severity", F.upper("category").alias("category"), "agent",
        truncate_text("message", 200).alias("issue"),
        truncate_text("recommendation", 200).alias("action_text"))
