"""Registered queries, part 4: conflicts, briefing and report data."""

from __future__ import annotations

from pyspark.sql import functions as F

from supplyscope.functions.columns import millions, pct_text, severity_rank
from supplyscope.operators import alerts as al
from supplyscope.operators import conflicts, models, reports, tables
from supplyscope.plans.catalog import feats, flagged, inventory, weekly
from supplyscope.plans.catalog_alerts import A_COLS, agent_alerts, all_alerts, conflict_alerts
from supplyscope.plans.catalog_models import all_preds
from supplyscope.plans.context import narrow_run, run_for
from supplyscope.plans.registry import register
from supplyscope.plans.sqlparts import SEQ, with_
from supplyscope.plans.sqlparts_alerts import CONFLICTS

W = with_(CONFLICTS)
SEV_R = "CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END"
MONEY_SUM = "CAST(sum(CAST(sales AS DECIMAL(18,2))) AS DOUBLE)"


@register("agt6_agt7_agt8_conflicts", W + f"\nSELECT {A_COLS} FROM conflict_alerts")
def q_conflicts(spark, d):
    """AGT6-9 + JON10 + SET4 + WIN4 + FLT9: conflict alerts."""
    return conflict_alerts(spark, d)


@register("agt10_all_alerts", W + f"\nSELECT {A_COLS} FROM all_alerts")
def q_all_alerts(spark, d):
    """AGT10: one run's alert table (agents, then conflicts)."""
    return all_alerts(spark, d)


@register("top10_briefing", W + f"""
SELECT id, severity, upper(category) AS category, agent,
       CASE WHEN length(message) > 200 THEN substr(message, 1, 200) || '...' ELSE message END AS issue,
       CASE WHEN length(recommendation) > 200 THEN substr(recommendation, 1, 200) || '...' ELSE recommendation END AS action_text
FROM all_alerts WHERE is_resolved = 0 AND severity IN ('CRITICAL', 'HIGH')
ORDER BY CASE severity WHEN 'CRITICAL' THEN 0 ELSE 1 END, created_at DESC, id ASC LIMIT 5""")
def q_top10(spark, d):
    """TOP10 + PRJ25: manager briefing, 5 items."""
    return conflicts.briefing(all_alerts(spark, d), 5)


@register("agg5_status_counts", W + "\nSELECT status, count(*) AS n FROM inventory_t GROUP BY status")
def q_agg5(spark, d):
    return reports.status_counts(inventory(spark, d))


@register("agg6_kpis", W + f""",
nw AS (SELECT p.predicted_value FROM preds p JOIN (SELECT product_name, min(label) AS ml FROM preds
       WHERE prediction_type = 'demand' GROUP BY product_name) s ON p.product_name = s.product_name AND p.label = s.ml
       WHERE p.prediction_type = 'demand')
SELECT count(*) AS total_orders, coalesce({MONEY_SUM}, 0.0) AS total_revenue,
       count(*) FILTER (WHERE fraud_label = 1) AS fraud_count,
       (SELECT count(*) FROM preds WHERE prediction_type = 'delivery' AND label = 'late') AS delivery_risk,
       (SELECT count(*) FROM preds WHERE prediction_type = 'inventory' AND label = 'critical') AS critical_stock,
       (SELECT count(*) FROM all_alerts WHERE is_resolved = 0) AS open_alerts,
       (SELECT CAST(floor(coalesce(sum(predicted_value), 0.0)) AS BIGINT) FROM nw) AS next_week_demand
FROM feat""")
def q_agg6(spark, d):
    """AGG6: dashboard KPI row."""
    p = all_preds(spark, d)
    return reports.kpis(run_for(spark, d).feats, p, all_alerts(spark, d), models.next_week_forecast(p))


@register("agg7_summary", W + """
SELECT count(*) AS total_orders, count(*) FILTER (WHERE fraud_label = 1) AS fraud_orders,
       (SELECT count(*) FROM all_alerts WHERE is_resolved = 0) AS open_alerts,
       (SELECT count(*) FROM inventory_t WHERE status = 'CRITICAL') AS critical_stock
FROM feat""")
def q_agg7(spark, d):
    """AGG7, from the run's stored tables."""
    run = run_for(spark, d)
    return reports.summary(run.feats, run.all_alerts, run.inventory)


@register("agg8_open_alerts_by_category", W + """
SELECT category, severity, count(*) AS n FROM all_alerts WHERE is_resolved = 0 GROUP BY category, severity""")
def q_agg8(spark, d):
    return reports.open_alert_counts(all_alerts(spark, d))


@register("agg8_open_alerts_pivot", W + """
SELECT category, count(*) FILTER (WHERE severity = 'CRITICAL') AS CRITICAL, count(*) FILTER (WHERE severity = 'HIGH') AS HIGH,
       count(*) FILTER (WHERE severity = 'MEDIUM') AS MEDIUM, count(*) FILTER (WHERE severity = 'LOW') AS LOW
FROM all_alerts WHERE is_resolved = 0 GROUP BY category""")
def q_agg8p(spark, d):
    return reports.open_alert_pivot(all_alerts(spark, d))


@register("agg9_revenue_by_market", W + f"""
SELECT market, {MONEY_SUM} AS revenue, count(*) AS orders FROM feat GROUP BY market""")
def q_agg9(spark, d):
    """AGG9: revenue and orders per market, highest revenue first."""
    return reports.revenue_by_market(feats(spark, d))


@register("agg10_fraud_by_market", W + f"""
SELECT market, count(*) AS count, {MONEY_SUM} AS revenue FROM feat WHERE fraud_label = 1 GROUP BY market""")
def q_agg10u(spark, d):
    """AGG10 over all fraud rows."""
    return reports.fraud_by(feats(spark, d), "market")


@register("agg11_agg17_fraud_segment_share", W + f"""
SELECT customer_segment, count, revenue, count / sum(count) OVER () AS share FROM
 (SELECT customer_segment, count(*) AS count, {MONEY_SUM} AS revenue FROM feat WHERE fraud_label = 1 GROUP BY customer_segment)""")
def q_agg11s(spark, d):
    """AGG11 + AGG17: fraud by segment with its share of all fraud."""
    return reports.shares(reports.fraud_by(feats(spark, d), "customer_segment"), "count")


@register("agg12_revenue_at_risk", W + f"""
SELECT {MONEY_SUM} AS revenue_at_risk, CAST(ROUND(CAST({MONEY_SUM} / 1e6 AS DECIMAL(38,10)), 2) AS DOUBLE) AS revenue_at_risk_m
FROM feat WHERE fraud_label = 1""")
def q_agg12(spark, d):
    """AGG12 + PRJ24."""
    return reports.revenue_at_risk(feats(spark, d))


DELIVERY_VIEW = """,
dv AS (SELECT p.order_id, p.predicted_value AS risk_prob, a.severity, a.message, a.recommendation, a.product_name,
              CAST(CAST(ROUND(CAST(p.predicted_value * 100 AS DECIMAL(38,10)), 1) AS DOUBLE) AS VARCHAR) || '%' AS risk_pct
       FROM (SELECT * FROM preds WHERE prediction_type = 'delivery' AND label = 'late') p
       LEFT JOIN all_alerts a ON a.order_id = p.order_id AND a.category = 'delivery'
)"""


def dview(spark, d):
    return reports.delivery_view(all_preds(spark, d), all_alerts(spark, d))


def risk_view(spark, d):
    """The delivery view for those who read its orders and risks only.

    Its predictions and alerts are those of a run that stores narrow lines and
    nothing else: the view's filters on the kind go down to each agent's rows,
    so no other agent's lines are computed to be left out, and no texts."""
    run = narrow_run(spark, d)
    return reports.delivery_view(run.preds, run.all_alerts)


@register("jon2_delivery_view", W + DELIVERY_VIEW + "\nSELECT * FROM dv")
def q_jon2(spark, d):
    """JON2 + PRJ23: predictions left-joined to delivery alerts, all rows."""
    return dview(spark, d)


@register("agg15_risk_tiers", W + DELIVERY_VIEW + """
SELECT count(*) FILTER (WHERE risk_prob >= 0.85) AS critical,
       count(*) FILTER (WHERE risk_prob >= 0.70 AND risk_prob < 0.85) AS high,
       count(*) FILTER (WHERE risk_prob < 0.70) AS medium FROM dv""")
def q_agg15(spark, d):
    """AGG15 + FLT6."""
    return reports.risk_tiers(risk_view(spark, d))


@register("agg16_risk_histogram", W + """,
sc AS (SELECT late_prob AS p FROM scored),
b AS (SELECT min(p) AS lo, max(p) AS hi FROM sc)
SELECT CAST(CASE WHEN hi > lo THEN least(floor((p - lo) * 20 / (hi - lo)) + 1, 20) ELSE 1 END AS INTEGER) AS bin, count(*) AS n
FROM sc CROSS JOIN b GROUP BY 1""")
def q_agg16(spark, d):
    """AGG16: 20-bin histogram of the late score over all lines."""
    s = models.delivery_rule_scores(feats(spark, d)).select(F.col("late_prob").alias("risk_prob"))
    return reports.risk_histogram(s)


@register("agg17_inventory_status_share", W + """
SELECT status, n, n / sum(n) OVER () AS share FROM (SELECT status, count(*) AS n FROM inventory_t GROUP BY status)""")
def q_agg17(spark, d):
    return reports.shares(reports.status_counts(inventory(spark, d)))


@register("agg18_alert_badges", W + """
SELECT count(*) AS total, count(*) FILTER (WHERE severity = 'CRITICAL') AS critical,
       count(*) FILTER (WHERE severity = 'HIGH') AS high, count(*) FILTER (WHERE severity = 'MEDIUM') AS medium,
       count(*) FILTER (WHERE severity = 'LOW') AS low, count(*) FILTER (WHERE is_resolved = 1) AS resolved
FROM all_alerts""")
def q_agg18(spark, d):
    return reports.alert_badges(all_alerts(spark, d))


@register("agg20_product_count", W + "\nSELECT count(DISTINCT product_name) AS products FROM feat")
def q_agg20(spark, d):
    return reports.product_count(feats(spark, d))


@register("agg20_product_list", W + """
SELECT DISTINCT product_name FROM weekly WHERE product_name IS NOT NULL AND product_name <> '' ORDER BY product_name""")
def q_agg20l(spark, d):
    return reports.product_list(weekly(spark, d))


@register("agg22_prediction_counts", W + """
SELECT prediction_type, label, count(*) AS n FROM preds GROUP BY prediction_type, label""")
def q_agg22(spark, d):
    return reports.prediction_counts(all_preds(spark, d))


@register("agg23_run_summary", W + """
SELECT count(*) AS rows, count(*) FILTER (WHERE fraud_label = 1) AS fraud, count(*) FILTER (WHERE fraud_label = 0) AS non_fraud,
       CAST(min(order_date) AS DATE) AS first_date, CAST(max(order_date) AS DATE) AS last_date,
       min(delay_days) AS min_delay, max(delay_days) AS max_delay,
       (SELECT count(*) FROM inventory_t) AS products,
       (SELECT count(*) FROM inventory_t WHERE status = 'CRITICAL') AS critical,
       (SELECT count(*) FROM inventory_t WHERE status = 'WARNING') AS warning
FROM feat""")
def q_agg23(spark, d):
    return reports.run_summary(feats(spark, d), inventory(spark, d))


@register("agg24_confusion", W + """
SELECT late_delivery_risk AS actual, CAST(late_prob >= 0.6 AS INTEGER) AS predicted, count(*) AS n FROM scored GROUP BY 1, 2""")
def q_agg24c(spark, d):
    """AGG24: confusion counts of the rule score at 0.60 against the truth."""
    s = models.delivery_rule_scores(feats(spark, d)).withColumn(
        "pred", (F.col("late_prob") >= 0.6).cast("int"))
    return reports.confusion_counts(s, "late_delivery_risk", "pred")


@register("agg24_classification_report", W + """,
conf AS (SELECT late_delivery_risk AS y, CAST(late_prob >= 0.6 AS INTEGER) AS p, count(*) AS n FROM scored GROUP BY 1, 2),
cls AS (SELECT y AS c FROM conf UNION SELECT p FROM conf),
per AS (SELECT c, sum(CASE WHEN y = c AND p = c THEN n ELSE 0 END) AS tp, sum(CASE WHEN p = c THEN n ELSE 0 END) AS pred_n,
               sum(CASE WHEN y = c THEN n ELSE 0 END) AS support FROM cls LEFT JOIN conf ON c = y OR c = p GROUP BY c),
pr AS (SELECT c, support,
              CAST(ROUND(CAST(CASE WHEN pred_n > 0 THEN tp / pred_n ELSE 0.0 END AS DECIMAL(38,10)), 6) AS DOUBLE) AS precision,
              CAST(ROUND(CAST(CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS DECIMAL(38,10)), 6) AS DOUBLE) AS recall FROM per)
SELECT CAST(c AS INTEGER) AS class, CAST(support AS BIGINT) AS support, precision, recall,
       CAST(ROUND(CAST(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS DECIMAL(38,10)), 6) AS DOUBLE) AS f1,
       CAST(ROUND(CAST((SELECT sum(CASE WHEN y = p THEN n ELSE 0 END) / sum(n) FROM conf) AS DECIMAL(38,10)), 6) AS DOUBLE) AS accuracy
FROM pr""")
def q_agg24(spark, d):
    """AGG24: precision / recall / F1 / support / accuracy."""
    s = models.delivery_rule_scores(feats(spark, d)).withColumn(
        "pred", (F.col("late_prob") >= 0.6).cast("int"))
    return reports.classification_report(s, "late_delivery_risk", "pred")


@register("flt3_top4_alerts_by_priority", W + f"""
SELECT {A_COLS} FROM all_alerts WHERE category = 'delivery' AND is_resolved = 0
ORDER BY {SEV_R}, created_at DESC, id ASC LIMIT 200""")
def q_flt3(spark, d):
    """FLT3 + TOP4: delivery alerts in priority order, first 200."""
    return reports.alerts_by_priority(all_alerts(spark, d), limit=200, category="delivery")


@register("flt4_newest_critical_alerts", W + f"""
SELECT {A_COLS} FROM all_alerts WHERE severity = 'CRITICAL' AND is_resolved = 0 ORDER BY created_at DESC, id ASC LIMIT 10""")
def q_flt4(spark, d):
    """FLT4: ``get_alerts(severity='CRITICAL', limit=10)``."""
    return reports.newest_alerts(all_alerts(spark, d), severity="CRITICAL", limit=10)


@register("flt8_all_passthrough", W + f"""
SELECT {A_COLS} FROM all_alerts WHERE is_resolved = 0""")
def q_flt8(spark, d):
    """FLT8: 'All' pick-list values pass everything."""
    return reports.filter_alerts(all_alerts(spark, d), category="All", severity="All")


@register("flt5_search_orders", W + f""",
o21 AS (SELECT *, strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date_s FROM feat
        WHERE product_name ILIKE '%gizmo%' OR order_region ILIKE '%gizmo%' OR category ILIKE '%gizmo%'
        ORDER BY {SEQ} LIMIT 100)
SELECT order_id, order_date_s AS order_date, product_name, category, department, market, order_region, customer_segment,
       sales, quantity, profit, discount_rate, shipping_mode, delivery_status, delay_days, fraud_label, is_high_value,
       order_year, order_month, order_week, order_season FROM o21""")
def q_flt5(spark, d):
    """FLT5 + DQ7: keyword search over the orders table, first 100."""
    from supplyscope.plans.catalog import orders_table
    return orders_table(reports.search_orders(flagged(spark, d), "gizmo", 100))


@register("top5_newest_predictions", W + """
SELECT id, created_at, prediction_type, product_name, order_id, predicted_value, confidence_score, label
FROM preds WHERE prediction_type = 'inventory' ORDER BY created_at DESC, id ASC LIMIT 50""")
def q_top5(spark, d):
    return reports.newest_predictions(all_preds(spark, d), "inventory", 50)


@register("top6_newest_weeks", W + """
SELECT product_name, order_year AS year, order_week AS week, CAST(weekly_qty AS DOUBLE) AS total_quantity, weekly_sales AS total_sales
FROM weekly ORDER BY order_year DESC, order_week DESC, product_name ASC, weekly_qty ASC, weekly_sales ASC LIMIT 100""")
def q_top6(spark, d):
    """TOP6: ``get_weekly_demand()`` newest first."""
    return reports.newest_weeks(tables.weekly_table(weekly(spark, d)), None, 100)


@register("top7_prj26_product_forecast", W + """
SELECT label AS week, CAST(ROUND(CAST(predicted_value AS DECIMAL(20,1)), 0) AS DOUBLE) AS forecast_qty,
       CAST(ROUND(CAST(confidence_score AS DECIMAL(20,1)), 0) AS DOUBLE) AS ci,
       greatest(CAST(ROUND(CAST(predicted_value AS DECIMAL(20,1)), 0) AS DOUBLE) - CAST(ROUND(CAST(confidence_score AS DECIMAL(20,1)), 0) AS DOUBLE) / 2, 0.0) AS lower,
       CAST(ROUND(CAST(predicted_value AS DECIMAL(20,1)), 0) AS DOUBLE) + CAST(ROUND(CAST(confidence_score AS DECIMAL(20,1)), 0) AS DOUBLE) / 2 AS upper
FROM (SELECT * FROM preds WHERE prediction_type = 'demand' AND product_name = 'red gizmo' ORDER BY label LIMIT 8)""")
def q_top7(spark, d):
    """TOP7 + PRJ26: one product's 8 forecast weeks with the band."""
    return reports.product_forecast(all_preds(spark, d), "red gizmo", 8)


@register("top8_prj37_lowest_stock", W + """
SELECT product_name AS "Product", category AS "Category", simulated_stock AS "Stock",
       CAST(ROUND(CAST(avg_daily_demand AS DECIMAL(38,10)), 2) AS DOUBLE) AS "Daily Demand",
       CAST(ROUND(CAST(days_remaining AS DECIMAL(38,10)), 1) AS DOUBLE) AS "Days Left", status AS "Status"
FROM inventory_t ORDER BY days_remaining ASC, product_name ASC LIMIT 30""")
def q_top8(spark, d):
    return reports.lowest_stock(inventory(spark, d), 30)


@register("top11_alert_split", W + f"""
SELECT id, severity, category, CASE WHEN severity IN ('CRITICAL', 'HIGH') THEN 'urgent' ELSE 'other' END AS "group"
FROM all_alerts WHERE is_resolved = 0 ORDER BY {SEV_R}, created_at DESC, id ASC LIMIT 8""")
def q_top11(spark, d):
    return reports.top_alerts_split(all_alerts(spark, d), 8)


@register("jon6_win3_fraud_view", W + """,
fa AS (SELECT order_id, severity FROM (
         SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY CASE severity WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' THEN 3
                WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 ELSE 0 END DESC, created_at DESC, id ASC) AS rn
         FROM all_alerts WHERE category = 'fraud' AND order_id IS NOT NULL) WHERE rn = 1)
SELECT CAST(f.order_id AS VARCHAR) AS "Order ID", f.product_name AS "Product", f.customer_segment AS "Segment",
       f.market AS "Market", f.order_region AS "Region", CAST(ROUND(CAST(f.sales AS DECIMAL(38,10)), 2) AS DOUBLE) AS "Sale ($)",
       f.delivery_status AS "Delivery Status", f.delay_days AS "Delay (days)", coalesce(fa.severity, 'MEDIUM') AS "Severity"
FROM fraud_all f LEFT JOIN fa ON f.order_id = fa.order_id""")
def q_jon6(spark, d):
    """JON6 + WIN3 + PRJ37: fraud orders with their first alert's severity."""
    return reports.fraud_view(al.fraud_orders(feats(spark, d)), all_alerts(spark, d))


@register("jon7_alert_with_risk", W + DELIVERY_VIEW + """,
fr AS (SELECT order_id, arg_max(risk_pct, risk_prob) AS risk_pct FROM dv GROUP BY order_id)
SELECT a.id, a.severity,
       CASE WHEN a.order_id IS NOT NULL THEN 'Order #' || CAST(a.order_id AS VARCHAR) ELSE substr(coalesce(a.product_name, ''), 1, 40) END AS subject,
       coalesce(fr.risk_pct, '') AS risk_pct,
       CASE WHEN length(a.message) > 200 THEN substr(a.message, 1, 200) || '...' ELSE a.message END AS message,
       CASE WHEN length(a.recommendation) > 150 THEN substr(a.recommendation, 1, 150) || '...' ELSE a.recommendation END AS recommendation,
       substr(a.created_at, 1, 16) AS time
FROM all_alerts a LEFT JOIN fr ON a.order_id = fr.order_id WHERE a.category = 'delivery'""")
def q_jon7(spark, d):
    """JON7 + PRJ25: delivery alerts with the order's risk % and short texts."""
    return reports.alert_with_risk(all_alerts(spark, d), dview(spark, d))


@register("prj27_fraud_rate", W + """
SELECT count(*) AS total, count(*) FILTER (WHERE fraud_label = 1) AS fraud,
       CAST(ROUND(CAST(count(*) FILTER (WHERE fraud_label = 1) / greatest(count(*), 1) * 100 AS DECIMAL(38,10)), 1) AS DOUBLE) AS fraud_rate_pct
FROM feat""")
def q_prj27(spark, d):
    return reports.fraud_rate(feats(spark, d))


@register("prj31_severity_rank", W + """
SELECT id, severity, CASE severity WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 ELSE 0 END AS severity_rank
FROM all_alerts""")
def q_prj31(spark, d):
    return all_alerts(spark, d).select("id", "severity", severity_rank("severity").alias("severity_rank"))


@register("prj24_market_revenue_m", W + f"""
SELECT market, CAST(ROUND(CAST({MONEY_SUM} / 1e6 AS DECIMAL(38,10)), 2) AS DOUBLE) AS revenue_m FROM feat GROUP BY market""")
def q_prj24(spark, d):
    """PRJ24: revenue in millions, 2 dp."""
    return reports.revenue_by_market(feats(spark, d)).select("market", millions("revenue").alias("revenue_m"))


@register("flagship_demand_vs_stock", W + """
SELECT o.product_name, o.week, o.forecast, o.ci, o.baseline,
       CAST(ROUND(CAST(CASE WHEN o.baseline > 0 THEN o.forecast / o.baseline END AS DECIMAL(38,10)), 4) AS DOUBLE) AS ratio,
       o.outcome, CASE o.outcome WHEN 'surge' THEN 'HIGH' WHEN 'decline' THEN 'MEDIUM' ELSE 'NONE' END AS severity,
       i.status AS stock_status, i.days_remaining, i.simulated_stock
FROM outc o LEFT JOIN inventory_t i ON o.product_name = i.product_name""")
def q_flagship(spark, d):
    """Flagship."""
    from supplyscope.plans.context import run_for
    from supplyscope.plans.flagship import demand_vs_stock_frames
    return demand_vs_stock_frames(run_for(spark, d, materialize=False))


@register("flt6_risk_band_critical", W + DELIVERY_VIEW + """
SELECT order_id, risk_prob FROM dv WHERE risk_prob >= 0.85""")
def q_flt6(spark, d):
    """FLT6: rows of the critical band (>= .85) of the delivery view."""
    return reports.risk_band(risk_view(spark, d), "critical").select("order_id", "risk_prob")


@register("flt6_risk_band_high", W + DELIVERY_VIEW + """
SELECT order_id, risk_prob FROM dv WHERE risk_prob >= 0.70 AND risk_prob < 0.85""")
def q_flt6h(spark, d):
    """FLT6: the half-open high band [.70, .85)."""
    return reports.risk_band(risk_view(spark, d), "high").select("order_id", "risk_prob")
