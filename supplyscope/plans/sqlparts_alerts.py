"""DuckDB SQL for predictions and alerts (oracle side)."""

from supplyscope.operators.models import BAND_Z
from supplyscope.plans.sqlparts import SEQ, SEQ_TEXT, WEEKLY

RUN_TS = "2026-01-01T00:00:00"


def hid(key_sql: str) -> str:
    """Same 60-bit id as ``hash_id`` (md5 of the '|'-joined key)."""
    return f"('0x' || substr(md5({key_sql}), 1, 15))::BIGINT"


def int_text(x: str) -> str:
    return f"CAST(CAST(ROUND(CAST({x} AS DECIMAL(38,6)), 0) AS BIGINT) AS VARCHAR)"


def dec_text(x: str, n: int) -> str:
    return f"CAST(CAST(ROUND(CAST({x} AS DECIMAL(38,6)), {n}) AS DECIMAL(38,{n})) AS VARCHAR)"


def money(x: str) -> str:
    return f"format('{{:,.2f}}', CAST(CAST({x} AS DECIMAL(20,2)) AS DOUBLE))"


def dround(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def key(*parts: str) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts) + ")"


BAND = f"CAST({2 * BAND_Z!r} AS DOUBLE)"

PREDS = WEEKLY + f""",
rates AS (SELECT shipping_mode, avg(late_delivery_risk) AS late_rate, count(*) AS orders
          FROM feat GROUP BY shipping_mode),
scored AS (SELECT f.*, {dround('r.late_rate', 4)} AS late_prob FROM feat f JOIN rates r USING (shipping_mode)),
dpred AS (
  SELECT {hid("'delivery|' || " + SEQ_TEXT)} AS id, '{RUN_TS}' AS created_at, 'delivery' AS prediction_type,
         CAST(NULL AS VARCHAR) AS product_name, order_id, late_prob AS predicted_value,
         late_prob AS confidence_score, 'late' AS label
  FROM scored WHERE late_prob >= 0.6),
ipred AS (
  SELECT {hid("'inventory|' || product_name")} AS id, '{RUN_TS}' AS created_at, 'inventory' AS prediction_type,
         product_name, CAST(NULL AS BIGINT) AS order_id,
         CAST(CASE lower(status) WHEN 'ok' THEN 0 WHEN 'safe' THEN 0 WHEN 'warning' THEN 1 WHEN 'low' THEN 1
              WHEN 'critical' THEN 2 ELSE 0 END AS DOUBLE) AS predicted_value,
         CAST(NULL AS DOUBLE) AS confidence_score,
         CASE lower(status) WHEN 'warning' THEN 'low' WHEN 'low' THEN 'low' WHEN 'critical' THEN 'critical'
              ELSE 'safe' END AS label
  FROM inventory_t),
ser AS (SELECT product_name, ds, date_diff('day', DATE '1970-01-05', ds) / CAST(7.0 AS DOUBLE) AS x,
               CAST(weekly_qty AS DOUBLE) AS y FROM weekly),
fit AS (SELECT product_name, count(*) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a,
               var_pop(y) AS vy, var_pop(x) AS vx, avg(y) AS my, max(ds) AS last
        FROM ser GROUP BY product_name HAVING count(*) >= 20),
steps AS (SELECT f.*, t.k, CAST(f.last + CAST(6 + (t.k - 1) * 7 AS INTEGER) AS DATE) AS fds
          FROM fit f CROSS JOIN range(1, 9) t(k)),
fc AS (SELECT product_name, fds AS ds,
              {dround("greatest(coalesce(a, my) + coalesce(b, 0.0) * (date_diff('day', DATE '1970-01-05', fds) / CAST(7.0 AS DOUBLE)), 0.0)", 1)} AS yhat,
              {dround(BAND + " * sqrt(greatest(vy - coalesce(b, 0.0) * coalesce(b, 0.0) * vx, 0.0))", 1)} AS ci
       FROM steps),
mpred AS (
  SELECT {hid(key("'demand'", "product_name", "ds"))} AS id, '{RUN_TS}' AS created_at, 'demand' AS prediction_type,
         product_name, CAST(NULL AS BIGINT) AS order_id, yhat AS predicted_value, ci AS confidence_score,
         strftime(ds, '%Y-%m-%d') AS label
  FROM fc),
preds AS (SELECT * FROM dpred UNION ALL SELECT * FROM ipred UNION ALL SELECT * FROM mpred),
baseline AS (SELECT product_name, CAST(round_even(CAST(avg(weekly_qty) AS DECIMAL(38,10)), 1) AS DOUBLE) AS baseline
             FROM weekly GROUP BY product_name)"""

ALERT_ID = hid("concat_ws('|', agent, category, akey)")


def facts(**values: str) -> str:
    """``name=value`` texts joined by "; "; NULL values are left out."""
    return "concat_ws('; ', " + ", ".join(f"'{k}=' || CAST({v} AS VARCHAR)" for k, v in values.items()) + ")"


CANCELED = "contains(lower(coalesce(delivery_status, '')), 'canceled')"
LAST = SEQ.replace(", ", " DESC, ") + " DESC"
CTX_COLS = ["product_name", "shipping_mode", "market", "order_region", "customer_segment", "sales", "department", "days_scheduled"]
FRAUD_MESSAGE = facts(
    order="order_id", product="product_name", value=money("coalesce(sales, 0.0)"), segment="nullif(customer_segment, '')",
    market="market", region="nullif(order_region, '')", department="nullif(department, '')", mode="shipping_mode",
    shipping=f"CASE WHEN {CANCELED} THEN 'canceled' END",
    late_days=f"CASE WHEN NOT {CANCELED} AND coalesce(delay_days, 0.0) > 1 THEN {int_text('coalesce(delay_days, 0.0)')} END")
DELIVERY_MESSAGE = facts(
    order="order_id", late_percent=int_text("coalesce(prob, 0.0) * 100"), product="product_name", department="department",
    market="market", region="order_region", mode="shipping_mode", mode_late_percent=int_text("mode_rate * 100"),
    lead_days=int_text("days_scheduled"), lead="CASE WHEN days_scheduled <= 2 THEN 'tight' END", value=money("sales"),
    segment="customer_segment")


def known(x: str) -> str:
    return f"CASE WHEN has THEN {x} END"


INVENTORY_MESSAGE = facts(
    product="product_name", stock_class="plabel", category="inv_category", stock=known("coalesce(simulated_stock, 0)"),
    per_day=known(dec_text("coalesce(avg_daily_demand, 0.0)", 1)), days_left=known(int_text("coalesce(days_remaining, 0.0)")),
    reorder_point=known(int_text("coalesce(reorder_threshold, 0.0)")), order_units=known("qty"),
    unit_price=known(dec_text("coalesce(product_price, 0.0)", 2)),
    cost=known(money("CAST(qty AS DECIMAL(20,0)) * CAST(coalesce(product_price, 0.0) AS DECIMAL(20,2))")))
DEMAND_MESSAGE = facts(
    product="product_name", trend="outcome", week="week", forecast=int_text("forecast"),
    low=f"CASE WHEN ci > 0 THEN {int_text('greatest(forecast - ci / 2, 0.0)')} END",
    high=f"CASE WHEN ci > 0 THEN {int_text('forecast + ci / 2')} END",
    change_percent=int_text("abs((forecast - baseline) / baseline * 100)"), usual=int_text("baseline"))

ALERTS = PREDS + f""",
fraud_all AS (SELECT * FROM feat WHERE fraud_label = 1),
fraud_top AS (SELECT * FROM fraud_all ORDER BY sales DESC, {SEQ} LIMIT 500),
fraud0 AS (
  SELECT order_id, product_name, {SEQ_TEXT} AS akey,
         CASE WHEN coalesce(sales, 0.0) >= 1000 THEN 'CRITICAL' WHEN coalesce(sales, 0.0) >= 500 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
         CASE WHEN coalesce(sales, 0.0) >= 1000 THEN 'immediate' WHEN coalesce(sales, 0.0) >= 500 THEN 'hold'
              WHEN {CANCELED} THEN 'investigate' ELSE 'monitor' END AS action,
         {FRAUD_MESSAGE} AS message
  FROM fraud_all),
fraud_alerts AS (
  SELECT order_id, product_name, severity, action, CAST(NULL AS VARCHAR) AS direction, message,
         {facts(action="action", order="order_id")} AS recommendation, 'FraudAgent' AS agent, 'fraud' AS category, akey
  FROM fraud0),
dlate AS (SELECT order_id, max(predicted_value) AS prob FROM preds
          WHERE prediction_type = 'delivery' AND label = 'late' GROUP BY order_id),
dtop AS (SELECT order_id, predicted_value AS prob FROM preds
         WHERE prediction_type = 'delivery' AND label = 'late'
         ORDER BY predicted_value DESC, order_id ASC, id ASC LIMIT 200),
ctx AS (SELECT order_id, {', '.join(f'first({c} ORDER BY {LAST}) AS {c}' for c in CTX_COLS)}
        FROM items WHERE order_id IN (SELECT order_id FROM dlate) GROUP BY order_id),
irates AS (SELECT shipping_mode, avg(late_delivery_risk) AS mode_rate FROM items GROUP BY shipping_mode),
dj AS (SELECT d.order_id, d.prob, c.product_name, c.shipping_mode, c.market, c.order_region, c.customer_segment,
              c.sales, c.department, c.days_scheduled, r.mode_rate,
              CASE WHEN coalesce(d.prob, 0.0) >= 0.85 THEN 'call_customer' WHEN coalesce(d.prob, 0.0) >= 0.70 THEN 'track' ELSE 'watch' END AS action
       FROM dlate d LEFT JOIN ctx c ON d.order_id = c.order_id LEFT JOIN irates r ON c.shipping_mode = r.shipping_mode),
delivery_alerts AS (
  SELECT order_id, product_name,
         CASE WHEN coalesce(prob, 0.0) >= 0.85 THEN 'CRITICAL' WHEN coalesce(prob, 0.0) >= 0.70 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
         action, CAST(NULL AS VARCHAR) AS direction, {DELIVERY_MESSAGE} AS message,
         {facts(action="action", order="order_id")} AS recommendation, 'DeliveryAgent' AS agent, 'delivery' AS category,
         CAST(order_id AS VARCHAR) AS akey
  FROM dj),
ipreds AS (SELECT product_name, lower(coalesce(label, 'safe')) AS plabel FROM preds
           WHERE prediction_type = 'inventory' AND lower(coalesce(label, 'safe')) <> 'safe'),
ij AS (SELECT p.product_name, p.plabel, i.simulated_stock, i.avg_daily_demand, i.days_remaining, i.reorder_threshold,
              i.product_price, i.category AS inv_category, i.product_name IS NOT NULL AS has,
              CASE WHEN p.plabel = 'critical' THEN 'rush_order' ELSE 'standard_order' END AS action,
              greatest(CAST(round_even(CAST(coalesce(i.avg_daily_demand, 0.0) AS DECIMAL(20,4))
                   * (CASE WHEN p.plabel = 'critical' THEN 14 ELSE 30 END + 5)
                   - CAST(coalesce(i.simulated_stock, 0) AS DECIMAL(20,4)), 0) AS BIGINT), 1) AS qty
       FROM ipreds p LEFT JOIN inventory_t i ON p.product_name = i.product_name),
inventory_alerts AS (
  SELECT CAST(NULL AS BIGINT) AS order_id, product_name,
         CASE WHEN plabel = 'critical' THEN 'CRITICAL' ELSE 'HIGH' END AS severity, action,
         CAST(NULL AS VARCHAR) AS direction, {INVENTORY_MESSAGE} AS message,
         {facts(action="action", product="product_name", units=known("qty"))} AS recommendation,
         'InventoryAgent' AS agent, 'inventory' AS category, product_name AS akey
  FROM ij),
nxt AS (SELECT p.product_name, p.label AS week, coalesce(p.predicted_value, 0.0) AS forecast,
               coalesce(p.confidence_score, 0.0) AS ci
        FROM preds p JOIN (SELECT product_name, min(label) AS label FROM preds WHERE prediction_type = 'demand'
                           GROUP BY product_name) m ON p.product_name = m.product_name AND p.label = m.label
        WHERE p.prediction_type = 'demand'),
outc AS (SELECT n.*, coalesce(b.baseline, 0.0) AS baseline,
                CASE WHEN coalesce(b.baseline, 0.0) <= 0 THEN 'no_baseline'
                     WHEN n.forecast / b.baseline >= 1.25 THEN 'surge'
                     WHEN n.forecast / b.baseline <= 0.75 THEN 'decline' ELSE 'normal' END AS outcome
         FROM nxt n LEFT JOIN baseline b ON n.product_name = b.product_name),
outa AS (SELECT *, CASE WHEN outcome = 'surge' THEN 'buy_more' ELSE 'hold_back' END AS action,
                CAST(greatest(floor(CASE WHEN outcome = 'surge' THEN forecast - baseline ELSE baseline - forecast END), 0) AS BIGINT) AS units
         FROM outc WHERE outcome IN ('surge', 'decline')),
demand_alerts AS (
  SELECT CAST(NULL AS BIGINT) AS order_id, product_name,
         CASE WHEN outcome = 'surge' THEN 'HIGH' ELSE 'MEDIUM' END AS severity, action,
         outcome AS direction, {DEMAND_MESSAGE} AS message,
         {facts(action="action", product="product_name", units="units")} AS recommendation,
         'DemandAgent' AS agent, 'demand' AS category, product_name AS akey
  FROM outa),
agent_alerts0 AS (
  SELECT * FROM fraud_alerts UNION ALL BY NAME SELECT * FROM delivery_alerts
  UNION ALL BY NAME SELECT * FROM inventory_alerts UNION ALL BY NAME SELECT * FROM demand_alerts),
agent_alerts AS (
  SELECT {ALERT_ID} AS id, '{RUN_TS}' AS created_at, agent, severity, category, product_name, order_id,
         message, recommendation, 0 AS is_resolved, action, direction
  FROM agent_alerts0)"""

STRONG = "coalesce(inv_sev, 'HIGH') IN ('HIGH', 'CRITICAL')"

CONFLICTS = ALERTS + f""",
oa AS (SELECT * FROM agent_alerts WHERE is_resolved = 0 AND category <> 'conflict'),
pa AS (SELECT * FROM oa WHERE product_name IS NOT NULL AND product_name <> ''),
pg AS (SELECT product_name,
              bool_or(category = 'inventory') AS has_inv, bool_or(category = 'demand') AS has_dem,
              bool_or(category = 'delivery') AS has_del, bool_or(category = 'fraud') AS has_fraud,
              first(severity ORDER BY created_at DESC, id ASC) FILTER (WHERE category = 'inventory') AS inv_sev,
              first(direction ORDER BY created_at DESC, id ASC) FILTER (WHERE category = 'demand') AS dem_dir
       FROM pa GROUP BY product_name),
c6 AS (SELECT product_name, CAST(NULL AS BIGINT) AS order_id, CASE WHEN {STRONG} THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
              {facts(product="product_name", rule="'restock_against_decline'", inventory="coalesce(inv_sev, 'HIGH')")} AS message,
              CASE WHEN {STRONG} THEN 'partial_reorder' ELSE 'defer' END AS action
       FROM pg WHERE has_inv AND has_dem AND dem_dir = 'decline'),
c7 AS (SELECT product_name, CAST(NULL AS BIGINT) AS order_id, 'HIGH' AS severity,
              {facts(product="product_name", rule="'late_and_short'")} AS message, 'compound' AS action
       FROM pg WHERE has_del AND has_inv AND NOT has_fraud),
og AS (SELECT order_id, list_distinct(list(category)) AS cats,
              array_to_string(list_sort(list_distinct(list(category) FILTER (WHERE category <> 'fraud'))), ', ') AS other_cats,
              array_to_string(list_sort(list_distinct(list(agent) FILTER (WHERE category <> 'fraud'))), ', ') AS other_agents
       FROM oa WHERE order_id IS NOT NULL GROUP BY order_id),
c8 AS (SELECT CAST(NULL AS VARCHAR) AS product_name, order_id, 'CRITICAL' AS severity,
              {facts(order="order_id", rule="'fraud_and_others'", agents="other_agents", categories="other_cats")} AS message,
              'block' AS action
       FROM og WHERE list_contains(cats, 'fraud') AND len(cats) > 1),
conf0 AS (SELECT *, {facts(action="action", product="product_name", order="order_id")} AS recommendation,
                 'ConflictResolver' AS agent, 'conflict' AS category,
                 concat_ws('|', action, coalesce(product_name, ''), coalesce(CAST(order_id AS VARCHAR), '')) AS akey FROM
            (SELECT * FROM c6 UNION ALL BY NAME SELECT * FROM c7 UNION ALL BY NAME SELECT * FROM c8)),
conflict_alerts AS (
  SELECT {ALERT_ID} AS id, '{RUN_TS}' AS created_at, agent, severity, category, product_name, order_id,
         message, recommendation, 0 AS is_resolved, action, CAST(NULL AS VARCHAR) AS direction
  FROM conf0),
all_alerts AS (SELECT * FROM agent_alerts UNION ALL SELECT * FROM conflict_alerts)"""
