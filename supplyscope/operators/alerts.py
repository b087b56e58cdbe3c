"""Alert rule jobs (AGT1-5, PRJ36, JON1/3-5, AGG21).

Each agent is a projection over a joined frame: every qualifying row in,
one alert row out, in the ``alerts`` schema.  Texts are ``name=value`` lists of
the figures behind the alert, so a reader and a parser get the same facts.
An alert's id is a hash of its agent, category and own key (order line, order
or product), unique within a run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope.functions.columns import dec_text, hash_id, int_text, money_text, nonempty
from supplyscope.operators.models import mode_late_rates, next_week_forecast, rate_of_mode
from supplyscope.operators.ranks import first_rows
from supplyscope.operators.sampling import ITEM_KEY

# Thresholds.
FRAUD_HIGH_VALUE = 500.0
FRAUD_CRITICAL_VALUE = 1000.0
DELIVERY_CRITICAL = 0.85
DELIVERY_HIGH = 0.70
LEAD_TIME_DAYS = 5
CRITICAL_BUFFER_DAYS = 14
LOW_BUFFER_DAYS = 30
SURGE_RATIO = 1.25
DECLINE_RATIO = 0.75

ALERT_COLS = ["id", "created_at", "agent", "severity", "category", "product_name", "order_id",
              "message", "recommendation", "is_resolved", "action", "direction"]


def facts(**values) -> F.Column:
    """``name=value`` texts joined by "; "; NULL values are left out."""
    return F.concat_ws("; ", *[F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in values.items()])


def finish(df: DataFrame, agent: str, category: str, run_ts: str, key) -> DataFrame:
    """Stamp agent, category, run time, id (from ``key``) and the open flag."""
    df = df.withColumns({"agent": F.lit(agent), "category": F.lit(category),
                         "created_at": F.lit(run_ts), "is_resolved": F.lit(0)})
    for c, t in (("action", "string"), ("direction", "string"), ("product_name", "string"),
                 ("order_id", "bigint")):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(t))
    df = df.withColumn("id", hash_id("agent", "category", *key))
    return df.select(
        F.col("id").cast("bigint"), "created_at", "agent", "severity", "category",
        F.col("product_name").cast("string"), F.col("order_id").cast("bigint"), "message",
        "recommendation", F.col("is_resolved").cast("int"), "action", "direction")


# ------------------------------------------------------------------ fraud

def fraud_orders(orders: DataFrame) -> DataFrame:
    """FLT1: all fraud lines."""
    return orders.where(F.col("fraud_label") == 1)


def top_fraud_orders(orders: DataFrame, limit: int = 500) -> DataFrame:
    """TOP1: fraud lines by sales desc (ties in item order), first ``limit``;
    found by thresholds (``first_rows``)."""
    keys = [-F.col("sales"), F.col("item_seq.order_id"), F.col("item_seq.line_number")]
    return first_rows(fraud_orders(orders), keys, [F.col("sales").desc(), F.col("item_seq").asc()], limit)


def fraud_alerts(orders: DataFrame, run_ts: str) -> DataFrame:
    """AGT1: one alert per fraud line; severity by value; action immediate /
    hold / investigate (cancelled shipping) / monitor."""
    f = fraud_orders(orders)
    canceled = F.lower(F.coalesce(F.col("delivery_status"), F.lit(""))).contains("canceled")
    sales = F.coalesce(F.col("sales"), F.lit(0.0))
    delay = F.coalesce(F.col("delay_days"), F.lit(0.0))
    severity = (F.when(sales >= FRAUD_CRITICAL_VALUE, "CRITICAL")
                .when(sales >= FRAUD_HIGH_VALUE, "HIGH").otherwise("MEDIUM"))
    action = (F.when(sales >= FRAUD_CRITICAL_VALUE, "immediate")
              .when(sales >= FRAUD_HIGH_VALUE, "hold")
              .when(canceled, "investigate").otherwise("monitor"))
    message = facts(order=F.col("order_id"), product=F.col("product_name"), value=money_text(sales),
                    segment=nonempty("customer_segment"), market=F.col("market"), region=nonempty("order_region"),
                    department=nonempty("department"), mode=F.col("shipping_mode"),
                    shipping=F.when(canceled, F.lit("canceled")),
                    late_days=F.when(~canceled & (delay > 1), int_text(delay)))
    out = f.select("item_seq", "order_id", "product_name", severity.alias("severity"), action.alias("action"),
                   message.alias("message"))
    out = out.withColumn("recommendation", facts(action=F.col("action"), order=F.col("order_id")))
    return finish(out, "FraudAgent", "fraud", run_ts, ITEM_KEY)


# ------------------------------------------------------------------ delivery

def late_predictions(predictions: DataFrame) -> DataFrame:
    """FLT2: late delivery predictions."""
    return predictions.where((F.col("prediction_type") == "delivery") & (F.col("label") == "late"))


def top_late_predictions(predictions: DataFrame, limit: int = 200) -> DataFrame:
    """TOP2: late delivery predictions, highest probability first."""
    return (late_predictions(predictions)
            .orderBy(F.col("predicted_value").desc(), F.col("order_id").asc(), F.col("id").asc())
            .limit(limit))


def late_orders(predictions: DataFrame) -> DataFrame:
    """Orders with a late line and their highest probability."""
    return late_predictions(predictions).groupBy("order_id").agg(F.max("predicted_value").alias("prob"))


def order_context(items: DataFrame, order_ids: DataFrame) -> DataFrame:
    """JON3 + WIN5: the last line (item order) of each wanted order.

    Lines are combined per order before they are shuffled; the orders, grouped
    by the same key, join without another shuffle of the lines."""
    ctx = F.struct("product_name", "shipping_mode", "market", "order_region", "customer_segment",
                   "sales", "department", "days_scheduled")
    last = items.groupBy("order_id").agg(F.max_by(ctx, "item_seq").alias("c")).select("order_id", "c.*")
    return last.join(order_ids.select("order_id").distinct(), "order_id", "left_semi")


def delivery_alerts(predictions: DataFrame, items: DataFrame, run_ts: str) -> DataFrame:
    """AGT2: one alert per late order, severity by its highest probability;
    order context and the mode's computed late rate in the message."""
    late = late_orders(predictions)
    j = late.join(order_context(items, late), "order_id", "left")
    j = j.withColumn("mode_rate", rate_of_mode(mode_late_rates(items), "late_rate", F.col("shipping_mode")))
    prob = F.coalesce(F.col("prob"), F.lit(0.0))
    severity = (F.when(prob >= DELIVERY_CRITICAL, "CRITICAL")
                .when(prob >= DELIVERY_HIGH, "HIGH").otherwise("MEDIUM"))
    action = (F.when(prob >= DELIVERY_CRITICAL, "call_customer")
              .when(prob >= DELIVERY_HIGH, "track").otherwise("watch"))
    message = facts(order=F.col("order_id"), late_percent=int_text(prob * 100), product=F.col("product_name"),
                    department=F.col("department"), market=F.col("market"), region=F.col("order_region"),
                    mode=F.col("shipping_mode"), mode_late_percent=int_text(F.col("mode_rate") * 100),
                    lead_days=int_text(F.col("days_scheduled")),
                    lead=F.when(F.col("days_scheduled") <= 2, F.lit("tight")),
                    value=money_text("sales"), segment=F.col("customer_segment"))
    out = j.select("order_id", "product_name", severity.alias("severity"), message.alias("message"),
                   action.alias("action"))
    out = out.withColumn("recommendation", facts(action=F.col("action"), order=F.col("order_id")))
    return finish(out, "DeliveryAgent", "delivery", run_ts, ["order_id"])


# ------------------------------------------------------------------ inventory

def reorder_quantity(daily, stock, label) -> F.Column:
    """AGT4: max(round(daily x (buffer + lead) - stock), 1), half-even;
    buffer 14 days if critical else 30; missing inputs count as 0, so the
    least quantity, 1, is the answer for them."""
    buf = F.when(label == "critical", CRITICAL_BUFFER_DAYS).otherwise(LOW_BUFFER_DAYS)
    need = (F.coalesce(daily, F.lit(0.0)).cast("decimal(20,4)") * (buf + LEAD_TIME_DAYS)
            - F.coalesce(stock, F.lit(0)).cast("decimal(20,4)"))
    return F.greatest(F.bround(need, 0).cast("bigint"), F.lit(1).cast("bigint"))


def inventory_alerts(predictions: DataFrame, inventory: DataFrame, run_ts: str) -> DataFrame:
    """AGT3: every inventory prediction that isn't safe, joined to the
    inventory row; critical -> CRITICAL, low -> HIGH."""
    preds = (predictions.where(F.col("prediction_type") == "inventory")
             .select("product_name", F.lower(F.coalesce("label", F.lit("safe"))).alias("plabel"))
             .where(F.col("plabel") != "safe"))
    inv = inventory.select("product_name", "simulated_stock", "avg_daily_demand", "days_remaining",
                           "reorder_threshold", "product_price", F.col("category").alias("inv_category"),
                           F.lit(True).alias("_has"))
    j = preds.join(inv, "product_name", "left")
    crit = F.col("plabel") == "critical"
    qty = reorder_quantity(F.col("avg_daily_demand"), F.col("simulated_stock"), F.col("plabel"))
    price = F.coalesce(F.col("product_price"), F.lit(0.0))
    has = F.col("_has").isNotNull()

    def known(c):
        return F.when(has, c)

    message = facts(
        product=F.col("product_name"), stock_class=F.col("plabel"), category=F.col("inv_category"),
        stock=known(F.coalesce(F.col("simulated_stock"), F.lit(0))),
        per_day=known(dec_text(F.coalesce(F.col("avg_daily_demand"), F.lit(0.0)), 1)),
        days_left=known(int_text(F.coalesce(F.col("days_remaining"), F.lit(0.0)))),
        reorder_point=known(int_text(F.coalesce(F.col("reorder_threshold"), F.lit(0.0)))),
        order_units=known(qty), unit_price=known(dec_text(price, 2)),
        cost=known(money_text(qty.cast("decimal(20,0)") * price.cast("decimal(20,2)"))))
    out = j.select("product_name", F.when(crit, "CRITICAL").otherwise("HIGH").alias("severity"),
                   message.alias("message"), F.when(crit, "rush_order").otherwise("standard_order").alias("action"),
                   known(qty).alias("_qty"))
    out = out.withColumn("recommendation", facts(action=F.col("action"), product=F.col("product_name"), units=F.col("_qty")))
    return finish(out, "InventoryAgent", "inventory", run_ts, ["product_name"])


# ------------------------------------------------------------------ demand

def demand_outcomes(predictions: DataFrame, baseline: DataFrame) -> DataFrame:
    """JON1 + JON5 + FLT12: next-week forecast per product against its
    baseline (default 0); ratio and outcome surge / decline / normal /
    no_baseline."""
    nxt = next_week_forecast(predictions).select(
        "product_name", F.col("label").alias("week"),
        F.coalesce("predicted_value", F.lit(0.0)).alias("forecast"),
        F.coalesce("confidence_score", F.lit(0.0)).alias("ci"))
    j = nxt.join(baseline, "product_name", "left").withColumn(
        "baseline", F.coalesce(F.col("baseline"), F.lit(0.0)))
    ratio = F.when(F.col("baseline") > 0, F.col("forecast") / F.col("baseline"))
    outcome = (F.when(F.col("baseline") <= 0, "no_baseline")
               .when(ratio >= SURGE_RATIO, "surge").when(ratio <= DECLINE_RATIO, "decline")
               .otherwise("normal"))
    return j.withColumns({"ratio": ratio, "outcome": outcome})


def demand_alerts(predictions: DataFrame, baseline: DataFrame, run_ts: str) -> DataFrame:
    """AGT5: surge (ratio >= 1.25) HIGH, decline (<= 0.75) MEDIUM."""
    o = demand_outcomes(predictions, baseline).where(F.col("outcome").isin("surge", "decline"))
    f, b, ci = F.col("forecast"), F.col("baseline"), F.col("ci")
    surge = F.col("outcome") == "surge"
    message = facts(product=F.col("product_name"), trend=F.col("outcome"), week=F.col("week"), forecast=int_text(f),
                    low=F.when(ci > 0, int_text(F.greatest(f - ci / 2, F.lit(0.0)))),
                    high=F.when(ci > 0, int_text(f + ci / 2)),
                    change_percent=int_text(F.abs((f - b) / b * 100)), usual=int_text(b))
    units = F.greatest(F.floor(F.when(surge, f - b).otherwise(b - f)), F.lit(0)).cast("bigint")
    out = o.select("product_name", F.when(surge, "HIGH").otherwise("MEDIUM").alias("severity"),
                   message.alias("message"), F.col("outcome").alias("direction"),
                   F.when(surge, "buy_more").otherwise("hold_back").alias("action"), units.alias("_units"))
    out = out.withColumn("recommendation", facts(action=F.col("action"), product=F.col("product_name"), units=F.col("_units")))
    return finish(out, "DemandAgent", "demand", run_ts, ["product_name"])


def demand_outcome_counts(predictions: DataFrame, baseline: DataFrame) -> DataFrame:
    """AGG19 (demand): surge / decline / normal / no-baseline counts."""
    return demand_outcomes(predictions, baseline).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n"))


def severity_counts(alerts: DataFrame) -> DataFrame:
    """AGG19: alerts per (agent, severity)."""
    return alerts.groupBy("agent", "severity").agg(F.count(F.lit(1)).alias("n"))
