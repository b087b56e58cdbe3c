"""Registered queries, part 5: table maintenance (functional forms) and
data-quality checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from supplyscope.operators import quality, sampling, sinks, tables
from supplyscope.plans.catalog import INV_COLS, ORDERS_SQL, draw_lines, flagged, inventory, orders_table
from supplyscope.plans.catalog_alerts import A_COLS, agent_alerts, all_alerts, conflict_alerts
from supplyscope.plans.catalog_models import PRED_COLS, all_preds
from supplyscope.plans.context import run_for
from supplyscope.plans.registry import register
from supplyscope.plans.sqlparts import SEQ, with_
from supplyscope.plans.sqlparts_alerts import CONFLICTS
from supplyscope.schemas import PREDICTION_TYPES, TABLE_SCHEMAS
from supplyscope.session import output_root

W = with_(CONFLICTS)
BASE_COLS = ("id, created_at, agent, severity, category, product_name, order_id, message, "
             "recommendation, is_resolved, action, direction")


def _inventory_updates(spark, d):
    """Two update batches for the non-OK products (seq 1 then seq 2)."""
    inv = inventory(spark, d).where(F.col("status") != "OK")
    v1 = inv.withColumns({"simulated_stock": F.col("simulated_stock") + 1, "_seq": F.lit(1)})
    v2 = inv.withColumns({"simulated_stock": F.col("simulated_stock") * 2, "status": F.lit("OK"),
                          "_seq": F.lit(2)})
    return v1.unionByName(v2)


@register("snk4_upsert_inventory", W + f""",
upd AS (SELECT * REPLACE (simulated_stock * 2 AS simulated_stock, 'OK' AS status) FROM inventory_t WHERE status <> 'OK')
SELECT {', '.join(INV_COLS)} FROM inventory_t WHERE product_name NOT IN (SELECT product_name FROM upd)
UNION ALL SELECT {', '.join(INV_COLS)} FROM upd""")
def q_snk4(spark, d):
    """SNK4: keyed upsert, last write in the batch wins."""
    return sinks.upsert(inventory(spark, d), _inventory_updates(spark, d), ["product_name"], "_seq")


def _keyed_batch(spark, d):
    """New alerts: a re-issue of each CRITICAL fraud alert (order key) and
    of each inventory alert (product key), with new text."""
    a = agent_alerts(spark, d)
    f = a.where((F.col("category") == "fraud") & (F.col("severity") == "CRITICAL"))
    i = a.where(F.col("category") == "inventory").withColumn("order_id", F.lit(None).cast("bigint"))
    b = f.unionByName(i).withColumns({
        "message": F.concat(F.lit("recheck=1; "), F.col("message")), "severity": F.lit("HIGH"),
        "id": F.col("id") + 1})
    # batch sequence: by message, then id, so that a key's last entry is defined
    return b.withColumn("seq", F.struct("message", "id"))


@register("snk7_insert_alert_keyed", W + f""",
b AS (SELECT * REPLACE ('recheck=1; ' || message AS message, 'HIGH' AS severity, id + 1 AS id)
      FROM (SELECT * FROM agent_alerts WHERE category = 'fraud' AND severity = 'CRITICAL'
            UNION ALL SELECT * REPLACE (CAST(NULL AS BIGINT) AS order_id) FROM agent_alerts WHERE category = 'inventory')),
bk AS (SELECT *, CASE WHEN order_id IS NOT NULL AND order_id <> 0 THEN 'order'
                      WHEN product_name IS NOT NULL AND product_name <> '' THEN 'product' ELSE 'message' END AS kind,
                 CASE WHEN order_id IS NOT NULL AND order_id <> 0 THEN CAST(order_id AS VARCHAR)
                      WHEN product_name IS NOT NULL AND product_name <> '' THEN product_name ELSE message END AS kv FROM b),
bl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY agent, category, kind, kv ORDER BY message DESC, id DESC) AS rn FROM bk) WHERE rn = 1)
SELECT {BASE_COLS} FROM agent_alerts a
WHERE NOT EXISTS (SELECT 1 FROM bl WHERE bl.kind = 'order' AND bl.agent = a.agent AND bl.category = a.category AND CAST(a.order_id AS VARCHAR) = bl.kv)
  AND NOT EXISTS (SELECT 1 FROM bl WHERE bl.kind = 'product' AND bl.agent = a.agent AND bl.category = a.category AND a.product_name = bl.kv)
  AND NOT EXISTS (SELECT 1 FROM bl WHERE bl.kind = 'message' AND bl.agent = a.agent AND bl.category = a.category AND a.message = bl.kv)
UNION ALL SELECT {BASE_COLS} FROM bl""")
def q_snk7(spark, d):
    """SNK7: keyed alert replace (order, else product, else message)."""
    return sinks.insert_alerts_keyed(agent_alerts(spark, d), _keyed_batch(spark, d), "seq")


@register("snk8_replace_alert_groups", W + f""",
nb AS (SELECT * FROM conflict_alerts UNION ALL
       SELECT * REPLACE ('LOW' AS severity) FROM agent_alerts WHERE agent = 'InventoryAgent' AND severity = 'HIGH')
SELECT {BASE_COLS} FROM agent_alerts a WHERE NOT EXISTS (SELECT 1 FROM nb WHERE nb.agent = a.agent AND nb.category = a.category)
UNION ALL SELECT {BASE_COLS} FROM nb""")
def q_snk8(spark, d):
    """SNK8: replace whole (agent, category) groups present in the batch."""
    a = agent_alerts(spark, d)
    nb = conflict_alerts(spark, d).unionByName(
        a.where("agent = 'InventoryAgent' AND severity = 'HIGH'").withColumn("severity", F.lit("LOW")))
    return sinks.replace_alert_groups(a, nb)


@register("snk8_empty_batch", W + f"\nSELECT {BASE_COLS} FROM agent_alerts")
def q_snk8e(spark, d):
    """SNK8: an empty batch deletes nothing."""
    a = agent_alerts(spark, d)
    return sinks.replace_alert_groups(a, a.limit(0))


@register("snk10_resolve_alerts", with_(CONFLICTS.replace("all_alerts AS (", "all_alerts AS MATERIALIZED (")) + f""",
done AS (SELECT DISTINCT id, created_at, 1 AS hit FROM all_alerts WHERE category = 'delivery' AND severity = 'CRITICAL')
SELECT {', '.join('a.' + c.strip() for c in BASE_COLS.split(',') if c.strip() != 'is_resolved')},
       CASE WHEN d.hit = 1 THEN 1 ELSE a.is_resolved END AS is_resolved
FROM all_alerts a LEFT JOIN done d ON a.id = d.id AND a.created_at = d.created_at""")
def q_snk10(spark, d):
    """SNK10: mark the CRITICAL delivery alerts resolved."""
    a = all_alerts(spark, d)
    r = a.where("category = 'delivery' AND severity = 'CRITICAL'").select("id", "created_at")
    return sinks.resolve(a, r).select(*[c.strip() for c in A_COLS.split(",")])


@register("snk11_delete_where", W + f"""
SELECT {BASE_COLS} FROM all_alerts WHERE NOT coalesce(category = 'delivery' AND severity = 'MEDIUM', false)""")
def q_snk11(spark, d):
    """SNK11: delete by predicate (NULL-safe)."""
    return sinks.delete_where(all_alerts(spark, d), (F.col("category") == "delivery") & (F.col("severity") == "MEDIUM"))


@register("snk12_freshness", W + f""",
hashed AS (SELECT *, md5('42|' || concat_ws('|', CAST(order_id AS VARCHAR), CAST(line_number AS VARCHAR), CAST(part_key AS VARCHAR),
           CAST(supp_key AS VARCHAR), strftime(ship_date, '%Y-%m-%d %H:%M:%S'), CAST(s_price AS VARCHAR), CAST(s_qty AS VARCHAR))) AS h FROM items),
loaded AS (SELECT order_id FROM hashed WHERE order_status = 'SUSPECTED_FRAUD'
           UNION ALL SELECT order_id FROM (SELECT * FROM hashed WHERE order_status <> 'SUSPECTED_FRAUD' ORDER BY h LIMIT 6000)),
e AS (SELECT count(*) FILTER (WHERE order_status = 'SUSPECTED_FRAUD') + least(count(*) FILTER (WHERE order_status <> 'SUSPECTED_FRAUD'), 6000) AS e FROM items)
SELECT (SELECT count(*) FROM loaded) AS loaded, e AS expected,
       abs((SELECT count(*) FROM loaded) - e) > greatest(50.0, e * 0.05) AS stale FROM e""")
def q_snk12(spark, d):
    """SNK12: loaded rows (SMP1 sample) against the expected count."""
    it = draw_lines(spark, d)
    return sinks.freshness(sampling.fraud_plus_sample(it), it)


@register("snk13_predictions_exist", W + """
SELECT (SELECT count(*) FROM (SELECT 1 FROM preds WHERE prediction_type = 'demand' LIMIT 1)) > 0 AS "exists" """)
def q_snk13(spark, d):
    return sinks.predictions_exist(all_preds(spark, d), "demand")


def _store_tables(spark, d):
    """The run's stored tables: a check reads them, it doesn't join the lines."""
    run = run_for(spark, d)
    return {"orders": run.feats, "inventory": run.inventory, "weekly_demand": run.weekly,
            "predictions": all_preds(spark, d), "alerts": all_alerts(spark, d)}


DQ1_SQL = """,
dq1 AS (
  SELECT 'rows:orders' AS "check", count(*) >= 5000 AS passed, CAST(count(*) AS VARCHAR) || ' >= 5000' AS detail FROM feat
  UNION ALL SELECT 'rows:inventory', count(*) >= 100, CAST(count(*) AS VARCHAR) || ' >= 100' FROM inventory_t
  UNION ALL SELECT 'rows:weekly_demand', count(*) >= 1000, CAST(count(*) AS VARCHAR) || ' >= 1000' FROM weekly
  UNION ALL SELECT 'rows:predictions', count(*) >= 5000, CAST(count(*) AS VARCHAR) || ' >= 5000' FROM preds
  UNION ALL SELECT 'rows:alerts', count(*) >= 20, CAST(count(*) AS VARCHAR) || ' >= 20' FROM all_alerts),
dq2 AS (
  SELECT 'summary:orders>0' AS "check", count(*) > 0 AS passed, CAST(count(*) AS VARCHAR) AS detail FROM feat
  UNION ALL SELECT 'summary:fraud<total', count(*) FILTER (WHERE fraud_label = 1) < count(*), CAST(count(*) FILTER (WHERE fraud_label = 1) AS VARCHAR) FROM feat
  UNION ALL SELECT 'summary:open_alerts>=0', true, CAST(count(*) FILTER (WHERE is_resolved = 0) AS VARCHAR) FROM all_alerts
  UNION ALL SELECT 'summary:critical_stock>=0', true, CAST(count(*) FILTER (WHERE status = 'CRITICAL') AS VARCHAR) FROM inventory_t),
dq3 AS (
  SELECT 'predictions:delivery:labels' AS "check", count(*) FILTER (WHERE label IS NULL OR label NOT IN ('late', 'on_time')) = 0 AS passed,
         CAST(count(*) FILTER (WHERE label IS NULL OR label NOT IN ('late', 'on_time')) AS VARCHAR) AS detail FROM preds WHERE prediction_type = 'delivery'
  UNION ALL SELECT 'predictions:delivery:values', count(*) FILTER (WHERE predicted_value IS NULL) = 0, CAST(count(*) FILTER (WHERE predicted_value IS NULL) AS VARCHAR) FROM preds WHERE prediction_type = 'delivery'
  UNION ALL SELECT 'predictions:inventory:labels', count(*) FILTER (WHERE label IS NULL OR label NOT IN ('safe', 'low', 'critical')) = 0,
         CAST(count(*) FILTER (WHERE label IS NULL OR label NOT IN ('safe', 'low', 'critical')) AS VARCHAR) FROM preds WHERE prediction_type = 'inventory'
  UNION ALL SELECT 'predictions:inventory:values', count(*) FILTER (WHERE predicted_value IS NULL) = 0, CAST(count(*) FILTER (WHERE predicted_value IS NULL) AS VARCHAR) FROM preds WHERE prediction_type = 'inventory'
  UNION ALL SELECT 'predictions:delivery:score_range', count(*) FILTER (WHERE NOT (confidence_score BETWEEN 0.0 AND 1.0)) = 0,
         CAST(count(*) FILTER (WHERE NOT (confidence_score BETWEEN 0.0 AND 1.0)) AS VARCHAR) FROM preds WHERE prediction_type = 'delivery'
  UNION ALL SELECT 'predictions:types', count(*) FILTER (WHERE prediction_type NOT IN ('delivery', 'demand', 'inventory')) = 0,
         CAST(count(*) FILTER (WHERE prediction_type NOT IN ('delivery', 'demand', 'inventory')) AS VARCHAR) FROM preds),
cl AS (SELECT * FROM (VALUES ('fraud'), ('delivery'), ('inventory'), ('demand'), ('conflict')) t(category)),
ag AS (SELECT category, count(*) FILTER (WHERE is_resolved = 0) AS open, count(*) FILTER (WHERE is_resolved = 1) AS resolved FROM all_alerts GROUP BY category),
dq4 AS (
  SELECT 'alerts:' || cl.category AS "check",
         (cl.category NOT IN ('fraud', 'delivery', 'inventory') OR coalesce(open, 0) + coalesce(resolved, 0) > 0) AS passed,
         CAST(coalesce(open, 0) AS VARCHAR) || ' open / ' || CAST(coalesce(resolved, 0) AS VARCHAR) || ' resolved' AS detail
  FROM cl LEFT JOIN ag ON cl.category = ag.category
  UNION ALL SELECT 'alerts:severity_domain', count(*) FILTER (WHERE severity NOT IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')) = 0,
         CAST(count(*) FILTER (WHERE severity NOT IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')) AS VARCHAR) FROM all_alerts
  UNION ALL SELECT 'alerts:unique_ids', count(*) = count(DISTINCT id), CAST(count(*) - count(DISTINCT id) AS VARCHAR) FROM all_alerts),
dq6 AS (
  SELECT 'inventory:columns' AS "check", true AS passed, 'ok' AS detail
  UNION ALL SELECT 'inventory:names', count(*) FILTER (WHERE product_name IS NULL) = 0, CAST(count(*) FILTER (WHERE product_name IS NULL) AS VARCHAR) FROM inventory_t
  UNION ALL SELECT 'inventory:stock>=0', count(*) FILTER (WHERE simulated_stock < 0) = 0, CAST(count(*) FILTER (WHERE simulated_stock < 0) AS VARCHAR) FROM inventory_t
  UNION ALL SELECT 'inventory:status_total', true, CAST(count(*) AS VARCHAR) FROM inventory_t),
dq AS (SELECT * FROM dq1 UNION ALL SELECT * FROM dq2 UNION ALL SELECT * FROM dq3 UNION ALL SELECT * FROM dq4 UNION ALL SELECT * FROM dq6)"""


@register("dq1_min_rows", W + DQ1_SQL + "\nSELECT * FROM dq1")
def q_dq1(spark, d):
    return quality.min_rows(_store_tables(spark, d))


@register("dq2_summary_sanity", W + DQ1_SQL + "\nSELECT * FROM dq2")
def q_dq2(spark, d):
    run = run_for(spark, d)
    return quality.summary_sanity(run.feats, run.all_alerts, run.inventory)


@register("dq3_prediction_checks", W + DQ1_SQL + "\nSELECT * FROM dq3")
def q_dq3(spark, d):
    return quality.prediction_checks(all_preds(spark, d))


@register("dq4_alert_coverage", W + DQ1_SQL + "\nSELECT * FROM dq4")
def q_dq4(spark, d):
    return quality.alert_coverage(all_alerts(spark, d))


@register("dq6_inventory_checks", W + DQ1_SQL + "\nSELECT * FROM dq6")
def q_dq6(spark, d):
    return quality.inventory_checks(inventory(spark, d))


@register("dq8_check_summary", W + DQ1_SQL + """
SELECT count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed, count(*) AS total,
       round(count(*) FILTER (WHERE passed) / greatest(count(*), 1) * 100, 1) AS percent,
       coalesce(array_to_string(list_sort(list("check") FILTER (WHERE NOT passed)), ', '), '') AS failures
FROM dq""")
def q_dq8(spark, d):
    """DQ8: summary over DQ1-4 and DQ6."""
    run = run_for(spark, d)
    c = (quality.min_rows(_store_tables(spark, d))
         .unionByName(quality.summary_sanity(run.feats, run.all_alerts, run.inventory))
         .unionByName(quality.prediction_checks(all_preds(spark, d)))
         .unionByName(quality.alert_coverage(all_alerts(spark, d)))
         .unionByName(quality.inventory_checks(run.inventory)))
    return quality.check_summary(c)


@register("dq7_search_checks", W + """
SELECT 'search:hit' AS "check", count(*) > 0 AS passed, CAST(count(*) AS VARCHAR) AS detail FROM
  (SELECT * FROM feat WHERE product_name ILIKE '%gizmo%' OR order_region ILIKE '%gizmo%' OR category ILIKE '%gizmo%' LIMIT 100)
UNION ALL SELECT 'search:miss', count(*) = 0, CAST(count(*) AS VARCHAR) FROM
  (SELECT * FROM feat WHERE product_name ILIKE '%qwxzv%' OR order_region ILIKE '%qwxzv%' OR category ILIKE '%qwxzv%' LIMIT 100)
UNION ALL SELECT 'search:width', true, '21'""")
def q_dq7(spark, d):
    """DQ7: search finds a known word, not a nonsense one; 21 columns."""
    return quality.search_checks(flagged(spark, d), "gizmo", "qwxzv")


# ---------------------------------------------------------------- stored tables

def _store(spark):
    """An empty store of its own for each query that writes one."""
    return sinks.TableStore(spark, output_root(spark, f"stores/{uuid.uuid4().hex}"))


@register("snk1_snk5_derived_tables", W + """
SELECT 'inventory' AS name, count(*) AS n, CAST(sum(simulated_stock) AS DOUBLE) AS total FROM inventory_t
UNION ALL SELECT 'weekly_demand', count(*), CAST(sum(weekly_qty) AS DOUBLE) FROM weekly""")
def q_snk1(spark, d):
    """SNK1 + SNK5: derived tables written, and written again over other rows."""
    run = run_for(spark, d)
    st, inv, week = _store(spark), run.inventory, tables.weekly_table(run.weekly)
    for name, frame in (("inventory", inv), ("weekly_demand", week)):
        st.overwrite(name, frame.limit(3))
        st.overwrite(name, frame)
    return (st.read("inventory").select(F.lit("inventory").alias("name"), F.count(F.lit(1)).alias("n"), F.sum("simulated_stock").cast("double").alias("total"))
            .unionByName(st.read("weekly_demand").select(F.lit("weekly_demand").alias("name"), F.count(F.lit(1)).alias("n"),
                                                         F.sum("total_quantity").alias("total"))))


@register("snk2_create_tables", W + f"""
SELECT {', '.join(INV_COLS)} FROM inventory_t""")
def q_snk2(spark, d):
    """SNK2: the five tables made twice; rows stored in between stay."""
    st = _store(spark)
    st.create_tables()
    st.append("inventory", inventory(spark, d))
    st.create_tables()
    assert all(st.exists(name) for name in TABLE_SCHEMAS)
    return st.read("inventory")


@register("snk3_replace_orders", with_(ORDERS_SQL) + "\nSELECT * FROM orders_t")
def q_snk3(spark, d):
    """SNK3: the stored orders replaced whole, read back."""
    st, orders = _store(spark), orders_table(run_for(spark, d).flagged)
    st.create_tables()
    st.append("orders", orders.limit(10))
    st.overwrite("orders", orders)
    return st.read("orders")


@register("snk6_append_predictions", W + f"""
SELECT {PRED_COLS} FROM preds""")
def q_snk6(spark, d):
    """SNK6: predictions appended type by type, read back."""
    st, preds = _store(spark), all_preds(spark, d)
    st.create_tables()
    for kind in PREDICTION_TYPES:
        st.append("predictions", preds.where(F.col("prediction_type") == kind))
    return st.read("predictions")


@register("snk9_clear_alerts", W + f"""
SELECT {BASE_COLS} FROM agent_alerts WHERE category = 'inventory'""")
def q_snk9(spark, d):
    """SNK9: all stored alerts cleared, resolutions with them; then one
    category is stored, and it is open."""
    st, a = _store(spark), agent_alerts(spark, d)
    st.write_alerts(a)
    st.resolve_alerts(a.where("category = 'inventory'").select("id"))
    st.clear_alerts()
    assert st.read("alerts").isEmpty()
    st.write_alerts(a.where("category = 'inventory'"))
    return st.read("alerts")


@register("src6_table_exists", W + """
SELECT 'inventory' AS name, true AS found, count(*) AS n FROM inventory_t UNION ALL SELECT 'no_such_table', false, 0""")
def q_src6(spark, d):
    """SRC6: a stored table is found, with its rows; another is not."""
    st = _store(spark)
    st.overwrite("inventory", inventory(spark, d))
    n = F.count(F.lit(1)).alias("n")
    one = st.read("inventory").select(F.lit("inventory").alias("name"), F.lit(st.exists("inventory")).alias("found"), n)
    return one.unionByName(st.read("inventory").limit(0).select(F.lit("no_such_table").alias("name"), F.lit(st.exists("no_such_table")).alias("found"), n))


@register("dq5_insert_resolve_round_trip", W + f"""
SELECT {BASE_COLS.replace('is_resolved', "CASE WHEN category = 'inventory' AND severity = 'CRITICAL' THEN 1 ELSE is_resolved END AS is_resolved")}
FROM agent_alerts""")
def q_dq5(spark, d):
    """DQ5: alerts stored, some resolved by id, all read back."""
    st, a = _store(spark), agent_alerts(spark, d)
    st.write_alerts(a)
    st.resolve_alerts(a.where("category = 'inventory' AND severity = 'CRITICAL'").select("id"))
    return st.read("alerts")
