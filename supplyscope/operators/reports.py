"""Report and dashboard data (AGG5-12, AGG15-18, AGG20-24, FLT3-9,
TOP4-8, TOP11, JON2, JON6, JON7, PRJ23-27, PRJ31, PRJ37).

All inputs are whole tables; windows without a partition key only run on
already-aggregated frames (a handful of rows)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supplyscope.functions.columns import (dec_round, millions, pct_text, severity_rank,
                                           truncate_text)


def money_sum(c: str) -> F.Column:
    """Exact sum of 2-dp money (DECIMAL), returned as DOUBLE."""
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


# ------------------------------------------------------------------ aggregates

def status_counts(inventory: DataFrame) -> DataFrame:
    """AGG5."""
    return inventory.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def kpis(orders: DataFrame, predictions: DataFrame, alerts: DataFrame, next_week: DataFrame) -> DataFrame:
    """AGG6: one KPI row.  Each figure is an aggregate over its own table
    (scalar subqueries: one small job each, no joins)."""
    o = orders.select(F.count(F.lit(1)).alias("n"), money_sum("sales").alias("rev"),
                      F.count_if(F.col("fraud_label") == 1).alias("fraud"))
    p = predictions.select(
        F.count_if((F.col("prediction_type") == "delivery") & (F.col("label") == "late")).alias("late"),
        F.count_if((F.col("prediction_type") == "inventory") & (F.col("label") == "critical")).alias("crit"))
    a = alerts.select(F.count_if(F.col("is_resolved") == 0).alias("open"))
    nw = next_week.select(F.floor(F.coalesce(F.sum("predicted_value"), F.lit(0.0))).cast("bigint").alias("nw"))
    return o.select(
        F.col("n").alias("total_orders"), F.coalesce(F.col("rev"), F.lit(0.0)).alias("total_revenue"),
        F.col("fraud").alias("fraud_count"), p.select("late").scalar().alias("delivery_risk"),
        p.select("crit").scalar().alias("critical_stock"), a.select("open").scalar().alias("open_alerts"),
        nw.select("nw").scalar().alias("next_week_demand"))


def summary(orders: DataFrame, alerts: DataFrame, inventory: DataFrame) -> DataFrame:
    """AGG7: orders, fraud, open alerts, CRITICAL inventory rows."""
    return orders.select(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(F.col("fraud_label") == 1).alias("fraud_orders"),
        alerts.select(F.count_if(F.col("is_resolved") == 0)).scalar().alias("open_alerts"),
        inventory.select(F.count_if(F.col("status") == "CRITICAL")).scalar().alias("critical_stock"))


def open_alert_counts(alerts: DataFrame) -> DataFrame:
    """AGG8: open alerts by (category, severity)."""
    return alerts.where(F.col("is_resolved") == 0).groupBy("category", "severity").agg(
        F.count(F.lit(1)).alias("n"))


def open_alert_pivot(alerts: DataFrame) -> DataFrame:
    """AGG8 (run summary form): one row per category, a column per severity."""
    sev = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
    p = (alerts.where(F.col("is_resolved") == 0).groupBy("category").pivot("severity", sev)
         .agg(F.count(F.lit(1))))
    return p.select("category", *[F.coalesce(F.col(s), F.lit(0)).cast("bigint").alias(s) for s in sev])


def revenue_by_market(orders: DataFrame) -> DataFrame:
    """AGG9 (the ordering is part of the result; AQE keeps it one small sort)."""
    return (orders.groupBy("market").agg(money_sum("sales").alias("revenue"),
                                         F.count(F.lit(1)).alias("orders"))
            .orderBy(F.desc("revenue"), F.asc("market")))


def fraud_by(frame: DataFrame, key: str) -> DataFrame:
    """AGG10 / AGG11: fraud count and revenue per key."""
    return (frame.where(F.col("fraud_label") == 1).groupBy(key)
            .agg(F.count(F.lit(1)).alias("count"), money_sum("sales").alias("revenue")))


def revenue_at_risk(frame: DataFrame) -> DataFrame:
    """AGG12 + PRJ24."""
    f = frame.where(F.col("fraud_label") == 1).select(money_sum("sales").alias("revenue_at_risk"))
    return f.withColumn("revenue_at_risk_m", millions(F.coalesce("revenue_at_risk", F.lit(0.0))))


def risk_tiers(frame: DataFrame, p: str = "risk_prob") -> DataFrame:
    """AGG15 + FLT6: counts in the half-open bands >= .85, [.70, .85), < .70."""
    x = F.col(p)
    return frame.select(F.count_if(x >= 0.85).alias("critical"),
                        F.count_if((x >= 0.70) & (x < 0.85)).alias("high"),
                        F.count_if(x < 0.70).alias("medium"))


def risk_band(frame: DataFrame, band: str, p: str = "risk_prob") -> DataFrame:
    """FLT6: rows of one band."""
    x = F.col(p)
    cond = {"critical": x >= 0.85, "high": (x >= 0.70) & (x < 0.85), "medium": x < 0.70}[band]
    return frame.where(cond)


def risk_histogram(frame: DataFrame, p: str = "risk_prob", bins: int = 20) -> DataFrame:
    """AGG16: equal-width bins between the observed min and max; the top
    value goes into the last bin.  Bounds are scalar subqueries."""
    lo = frame.select(F.min(p)).scalar()
    hi = frame.select(F.max(p)).scalar()
    b = F.when(hi > lo, F.least(F.floor((F.col(p) - lo) * bins / (hi - lo)) + 1, F.lit(bins))).otherwise(1)
    return frame.select(b.cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def shares(counts: DataFrame, n: str = "n") -> DataFrame:
    """AGG17: share of the total per slice (the window runs over the
    already-aggregated slices)."""
    return counts.withColumn("share", F.col(n) / F.sum(n).over(Window.partitionBy()))


def alert_badges(alerts: DataFrame) -> DataFrame:
    """AGG18: total, per severity, resolved."""
    s = F.col("severity")
    return alerts.select(
        F.count(F.lit(1)).alias("total"), F.count_if(s == "CRITICAL").alias("critical"),
        F.count_if(s == "HIGH").alias("high"), F.count_if(s == "MEDIUM").alias("medium"),
        F.count_if(s == "LOW").alias("low"), F.count_if(F.col("is_resolved") == 1).alias("resolved"))


def product_count(orders: DataFrame) -> DataFrame:
    """AGG20."""
    return orders.select(F.countDistinct("product_name").alias("products"))


def product_list(weekly: DataFrame) -> DataFrame:
    """AGG20 (pick list): all distinct non-empty products, sorted."""
    return (weekly.where(F.col("product_name").isNotNull() & (F.col("product_name") != ""))
            .select("product_name").distinct().orderBy("product_name"))


def prediction_counts(predictions: DataFrame) -> DataFrame:
    """AGG22."""
    return predictions.groupBy("prediction_type", "label").agg(F.count(F.lit(1)).alias("n"))


def run_summary(features: DataFrame, inventory: DataFrame) -> DataFrame:
    """AGG23: rows, fraud / non-fraud, date and delay ranges, stock tiers."""
    return features.select(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("fraud_label") == 1).alias("fraud"),
        F.count_if(F.col("fraud_label") == 0).alias("non_fraud"),
        F.min("order_date").cast("date").alias("first_date"),
        F.max("order_date").cast("date").alias("last_date"),
        F.min("delay_days").alias("min_delay"), F.max("delay_days").alias("max_delay"),
        inventory.select(F.count(F.lit(1))).scalar().alias("products"),
        inventory.select(F.count_if(F.col("status") == "CRITICAL")).scalar().alias("critical"),
        inventory.select(F.count_if(F.col("status") == "WARNING")).scalar().alias("warning"))


def classification_report(scored: DataFrame, y: str, yhat: str) -> DataFrame:
    """AGG24: per class precision / recall / F1 / support and overall
    accuracy (0 on zero division), from one confusion-count aggregate."""
    conf = scored.groupBy(F.col(y).alias("y"), F.col(yhat).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    # per-class counts as three aggregates joined on the class (equi-joins)
    sup = conf.groupBy(F.col("y").alias("cls")).agg(F.sum("n").alias("support"))
    prd = conf.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("pred_n"))
    tp = conf.where(F.col("y") == F.col("p")).groupBy(F.col("y").alias("cls")).agg(F.sum("n").alias("tp"))
    per = sup.join(prd, "cls", "full").join(tp, "cls", "left").fillna(0, subset=["support", "pred_n", "tp"])
    prec = F.when(F.col("pred_n") > 0, F.col("tp") / F.col("pred_n")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    acc = conf.select((F.sum(F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)) / F.sum("n"))).scalar()
    out = per.select(F.col("cls").cast("int").alias("class"), F.col("support").cast("bigint").alias("support"),
                     dec_round(prec, 6).alias("precision"), dec_round(rec, 6).alias("recall"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return out.withColumns({"f1": dec_round(f1, 6), "accuracy": dec_round(acc, 6)})


def confusion_counts(scored: DataFrame, y: str, yhat: str) -> DataFrame:
    """AGG24: confusion matrix as (actual, predicted, n)."""
    return scored.groupBy(F.col(y).alias("actual"), F.col(yhat).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ filters / top-k

def filter_alerts(alerts: DataFrame, category: str | None = None, severity: str | None = None,
                  resolved: bool = False) -> DataFrame:
    """FLT3 / FLT4 / FLT8: optional predicates folded with AND ('All' or
    None passes everything)."""
    preds = [F.lit(True)]
    if category and category != "All":
        preds.append(F.col("category") == category)
    if severity and severity != "All":
        preds.append(F.col("severity") == severity)
    if not resolved:
        preds.append(F.col("is_resolved") == 0)
    return alerts.where(reduce(lambda a, b: a & b, preds))


def alerts_by_priority(alerts: DataFrame, limit: int = 500, **kw) -> DataFrame:
    """FLT3 + TOP4 + PRJ31: severity rank (CRITICAL first, unknown last),
    then newest, then id; first ``limit``."""
    r = F.when(F.col("severity") == "CRITICAL", 1).when(F.col("severity") == "HIGH", 2)\
        .when(F.col("severity") == "MEDIUM", 3).otherwise(4)
    return (filter_alerts(alerts, **kw).withColumn("_r", r)
            .orderBy("_r", F.col("created_at").desc(), F.col("id").asc()).limit(limit).drop("_r"))


def newest_alerts(alerts: DataFrame, severity: str | None = None, resolved: bool = False,
                  limit: int = 500) -> DataFrame:
    """FLT4: ``get_alerts`` — newest first."""
    return (filter_alerts(alerts, severity=severity, resolved=resolved)
            .orderBy(F.col("created_at").desc(), F.col("id").asc()).limit(limit))


def search_orders(orders: DataFrame, keyword: str, limit: int = 100) -> DataFrame:
    """FLT5: case-insensitive substring search over product, region and
    category (``%``/``_`` in the keyword act as wildcards, as in LIKE);
    first ``limit`` rows in item order."""
    pat = f"%{keyword}%"
    cond = (F.col("product_name").ilike(pat) | F.col("order_region").ilike(pat)
            | F.col("category").ilike(pat))
    return orders.where(cond).orderBy("item_seq").limit(limit)


def newest_predictions(predictions: DataFrame, prediction_type: str | None = None,
                       limit: int = 1000) -> DataFrame:
    """TOP5."""
    p = predictions if prediction_type is None else predictions.where(
        F.col("prediction_type") == prediction_type)
    return p.orderBy(F.col("created_at").desc(), F.col("id").asc()).limit(limit)


def newest_weeks(weekly_table: DataFrame, product: str | None = None, limit: int = 100) -> DataFrame:
    """TOP6: weekly rows newest first (ties by product and quantity)."""
    w = weekly_table if product is None else weekly_table.where(F.col("product_name") == product)
    return w.orderBy(F.col("year").desc(), F.col("week").desc(), F.col("product_name").asc(),
                     F.col("total_quantity").asc(), F.col("total_sales").asc()).limit(limit)


def product_forecast(predictions: DataFrame, product: str, weeks: int = 8) -> DataFrame:
    """TOP7 + PRJ26: the forecast weeks of one product in week order, with
    the band qty +- ci/2 (lower clipped at 0) on rounded inputs."""
    p = (predictions.where((F.col("prediction_type") == "demand") & (F.col("product_name") == product))
         .orderBy("label").limit(weeks))
    q = F.round(F.col("predicted_value").cast("decimal(20,1)"), 0).cast("double")
    ci = F.round(F.col("confidence_score").cast("decimal(20,1)"), 0).cast("double")
    return p.select(F.col("label").alias("week"), q.alias("forecast_qty"), ci.alias("ci")).withColumns({
        "lower": F.greatest(F.col("forecast_qty") - F.col("ci") / 2, F.lit(0.0)),
        "upper": F.col("forecast_qty") + F.col("ci") / 2})


def lowest_stock(inventory: DataFrame, n: int = 30) -> DataFrame:
    """TOP8 + PRJ37: fewest days of stock first, display rounding."""
    return (inventory.orderBy(F.col("days_remaining").asc(), F.col("product_name").asc()).limit(n)
            .select(F.col("product_name").alias("Product"), F.col("category").alias("Category"),
                    F.col("simulated_stock").alias("Stock"),
                    dec_round("avg_daily_demand", 2).alias("Daily Demand"),
                    dec_round("days_remaining", 1).alias("Days Left"), F.col("status").alias("Status")))


def top_alerts_split(alerts: DataFrame, k: int = 8) -> DataFrame:
    """TOP11: first k alerts in priority order, tagged by severity group."""
    a = alerts_by_priority(alerts, limit=k)
    return a.select("id", "severity", "category", F.when(F.col("severity").isin("CRITICAL", "HIGH"), "urgent")
                    .otherwise("other").alias("group"))


# ------------------------------------------------------------------ joins

def delivery_view(predictions: DataFrame, alerts: DataFrame, limit: int | None = None) -> DataFrame:
    """JON2 + PRJ23: late predictions left-joined to delivery alerts on
    order_id (the category test inside ON); with ``limit`` the highest risks
    only."""
    p = predictions.where((F.col("prediction_type") == "delivery") & (F.col("label") == "late")).select(
        "order_id", F.col("predicted_value").alias("risk_prob"), F.col("id").alias("pid"))
    a = alerts.select(F.col("order_id").alias("a_oid"), F.col("category").alias("a_cat"), "severity", "message",
                      "recommendation", "product_name", F.col("id").alias("aid"))
    j = p.join(a, (F.col("a_oid") == F.col("order_id")) & (F.col("a_cat") == "delivery"), "left")
    if limit is not None:
        j = j.orderBy(F.col("risk_prob").desc(), F.col("order_id").asc(), F.col("pid").asc(),
                      F.col("aid").asc_nulls_first()).limit(limit)
    return j.select("order_id", "risk_prob", "severity", "message", "recommendation", "product_name",
                    pct_text("risk_prob").alias("risk_pct"))


def first_alert_per_order(alerts: DataFrame) -> DataFrame:
    """WIN3: the first alert of each order in priority order (severity
    rank, newest, id).  The window is partitioned by order."""
    w = Window.partitionBy("order_id").orderBy(severity_rank("severity").desc(), F.col("created_at").desc(),
                                               F.col("id").asc())
    return (alerts.where(F.col("order_id").isNotNull()).withColumn("_rn", F.row_number().over(w))
            .where("_rn = 1").drop("_rn"))


def fraud_view(fraud_orders: DataFrame, alerts: DataFrame) -> DataFrame:
    """JON6 + PRJ37: fraud orders with the first fraud alert's severity
    (default MEDIUM), display rounding and names."""
    fa = first_alert_per_order(alerts.where(F.col("category") == "fraud")).select(
        "order_id", F.col("severity").alias("_sev"), F.col("recommendation").alias("_rec"))
    j = fraud_orders.join(fa, "order_id", "left")
    return j.select(F.col("order_id").cast("string").alias("Order ID"), F.col("product_name").alias("Product"),
                    F.col("customer_segment").alias("Segment"), F.col("market").alias("Market"),
                    F.col("order_region").alias("Region"), dec_round("sales", 2).alias("Sale ($)"),
                    F.col("delivery_status").alias("Delivery Status"), F.col("delay_days").alias("Delay (days)"),
                    F.coalesce("_sev", F.lit("MEDIUM")).alias("Severity"))


def alert_with_risk(alerts: DataFrame, delivery: DataFrame) -> DataFrame:
    """JON7 + PRJ25: delivery alerts with the first matching risk % of
    their order and a short label (order, else product <= 40 chars)."""
    first = (delivery.groupBy("order_id").agg(F.max_by("risk_pct", "risk_prob").alias("risk_pct")))
    a = alerts.where(F.col("category") == "delivery")
    j = a.join(first, "order_id", "left")
    label = F.when(F.col("order_id").isNotNull(), F.concat(F.lit("Order #"), F.col("order_id").cast("string")))\
        .otherwise(F.substring(F.coalesce("product_name", F.lit("")), 1, 40))
    return j.select("id", "severity", label.alias("subject"), F.coalesce("risk_pct", F.lit("")).alias("risk_pct"),
                    truncate_text("message", 200).alias("message"),
                    truncate_text("recommendation", 150).alias("recommendation"),
                    F.substring("created_at", 1, 16).alias("time"))


def fraud_rate(orders: DataFrame) -> DataFrame:
    """PRJ27: fraud / max(total, 1) x 100, 1 dp."""
    return orders.select(F.count(F.lit(1)).alias("total"), F.count_if(F.col("fraud_label") == 1).alias("fraud")
                         ).withColumn("fraud_rate_pct", dec_round(F.col("fraud") / F.greatest("total", F.lit(1)) * 100, 1))
