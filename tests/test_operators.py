import datetime as dt

import pytest
from pyspark.sql import functions as F

from supplyscope.operators import alerts, clean, conflicts, encode, features, models, reports, sinks, tables
from supplyscope.sources.tables import ITEM_SEQ_FIELDS

TS = "2026-01-01T00:00:00"


def fraud_rows(spark, rows):
    df = spark.createDataFrame(rows, "order_id long, sales double, delivery_status string, delay_days double")
    return df.select(
        "*", F.lit(1).alias("fraud_label"), F.lit("p").alias("product_name"), F.lit("Consumer").alias("customer_segment"),
        F.lit("EUROPE").alias("market"), F.lit("FRANCE").alias("order_region"), F.lit("d").alias("department"),
        F.lit("Same Day").alias("shipping_mode"), F.struct(*[F.col("order_id").alias(f) for f in ITEM_SEQ_FIELDS]).alias("item_seq"))


def test_fraud_severity_boundaries(spark):
    df = fraud_rows(spark, [(1, 1000.0, "Late delivery", 0.0), (2, 999.99, "x", 0.0), (3, 500.0, "x", 0.0),
                            (4, 499.99, "Shipping canceled", 0.0), (5, 10.0, "Late delivery", 3.0)])
    a = {r["order_id"]: (r["severity"], r["action"]) for r in alerts.fraud_alerts(df, TS).collect()}
    assert a == {1: ("CRITICAL", "immediate"), 2: ("HIGH", "hold"), 3: ("HIGH", "hold"),
                 4: ("MEDIUM", "investigate"), 5: ("MEDIUM", "monitor")}
    msg = alerts.fraud_alerts(df, TS).where("order_id = 5").first()["message"]
    assert "late_days=3" in msg and "value=10.00" in msg


def test_delivery_severity_boundaries(spark):
    preds = spark.createDataFrame(
        [(i, "delivery", None, o, p, p, "late") for i, (o, p) in enumerate([(1, 0.85), (2, 0.8499), (3, 0.70), (4, 0.6999)])],
        "id long, prediction_type string, product_name string, order_id long, predicted_value double, confidence_score double, label string")
    items = spark.createDataFrame([(9, "x")], "order_id long, product_name string").select(
        "order_id", "product_name", F.lit("Same Day").alias("shipping_mode"), F.lit("m").alias("market"),
        F.lit("r").alias("order_region"), F.lit("c").alias("customer_segment"), F.lit(1.0).alias("sales"),
        F.lit("d").alias("department"), F.lit(0).alias("days_scheduled"), F.lit(1).alias("late_delivery_risk"),
        F.struct(F.col("order_id")).alias("item_seq"))
    got = {r["order_id"]: r["severity"] for r in alerts.delivery_alerts(preds, items, TS).collect()}
    assert got == {1: "CRITICAL", 2: "HIGH", 3: "HIGH", 4: "MEDIUM"}


def test_demand_thresholds_and_ties(spark):
    preds = spark.createDataFrame([
        ("a", "2020-01-05", 125.0), ("a", "2020-01-12", 1.0),
        ("b", "2020-01-05", 75.0), ("c", "2020-01-05", 100.0), ("d", "2020-01-05", 5.0),
        ("e", "2020-01-05", 1.0), ("e", "2020-01-05", 2.0)],
        "product_name string, label string, predicted_value double").select(
        F.lit("demand").alias("prediction_type"), "*", F.lit(10.0).alias("confidence_score"))
    base = spark.createDataFrame([("a", 100.0), ("b", 100.0), ("c", 100.0), ("d", 0.0), ("e", 1.0)],
                                 "product_name string, baseline double")
    out = {r["product_name"]: r["outcome"] for r in alerts.demand_outcomes(preds, base).collect()}
    assert out["a"] == "surge" and out["b"] == "decline" and out["c"] == "normal" and out["d"] == "no_baseline"
    assert models.next_week_forecast(preds).where("product_name = 'e'").count() == 2  # ties kept
    a = alerts.demand_alerts(preds, base, TS).where("product_name IN ('a','b')").collect()
    assert {r["product_name"]: r["severity"] for r in a} == {"a": "HIGH", "b": "MEDIUM"}


def test_reorder_quantity(spark):
    df = spark.createDataFrame([(2.0, 10, "critical"), (2.0, 10, "low"), (0.1, 100, "low"), (None, None, "low")],
                               "d double, s long, l string")
    q = [r[0] for r in df.select(alerts.reorder_quantity(F.col("d"), F.col("s"), F.col("l"))).collect()]
    assert q == [28, 60, 1, 1]


def test_guards(spark):
    df = spark.createDataFrame([(0.0, 5.0, 10.0, 0.1)], "sales double, profit double, product_price double, discount_rate double")
    r = features.add_discount_amount(features.add_profit_margin(df)).first()
    assert r["profit_margin"] == 0.0 and r["discount_amount"] == 1.0


def test_inventory_zero_demand_and_status(spark):
    rows = [(1, "p", 0, dt.datetime(2020, 1, 1), 1.0, "c", "d"), (2, "p", 0, dt.datetime(2020, 3, 1), 1.0, "c", "d")]
    df = spark.createDataFrame(rows, "order_id long, product_name string, quantity long, order_date timestamp_ntz, "
                                     "product_price double, category string, department string")
    df = df.withColumn("item_seq", F.struct("order_id"))
    r = tables.build_inventory(df).first()
    assert r["days_remaining"] == 999.0 and r["simulated_stock"] == 1 and r["status"] == "OK"


def test_label_codes_are_a_bijection(spark, sf_small):
    from supplyscope.sources import order_items
    it = order_items(spark, sf_small)
    m = encode.fit_label_codes(it, ["market", "product_name"])
    for c in ("market", "product_name"):
        s = m.where(F.col("column_name") == c)
        n = s.count()
        assert s.select("code").distinct().count() == n
        assert s.agg(F.min("code"), F.max("code")).first() == (0, n - 1)


def test_scaling_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    out, _ = encode.scale(df, ["x", "k"])
    rows = out.orderBy("x").collect()
    assert [r["x_std"] for r in rows] == [-1.0, 1.0]
    assert [r["k_std"] for r in rows] == [0.0, 0.0] and [r["k_norm"] for r in rows] == [0.0, 0.0]
    assert [r["x_norm"] for r in rows] == [0.0, 1.0]


def test_fill_median_and_report(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None), (3.0, "b"), (10.0, "c")], "v double, t string")
    out = clean.fill_text(clean.fill_median(df, ["v"]))
    assert sorted(r["v"] for r in out.collect()) == [1.0, 3.0, 3.0, 10.0]
    assert out.where("t = 'Unknown'").count() == 1
    rep = {r["column_name"]: r["missing"] for r in clean.missing_report(df).collect()}
    assert rep == {"v": 1, "t": 1}


def alert_frame(spark, rows):
    return spark.createDataFrame(rows, "id long, created_at string, agent string, severity string, category string, "
                                       "product_name string, order_id long, message string, recommendation string, "
                                       "is_resolved int, action string, direction string")


def test_insert_alert_keyed_rules(spark):
    base = alert_frame(spark, [
        (1, "t", "A", "LOW", "fraud", "p1", 7, "m1", "r", 0, None, None),
        (2, "t", "A", "LOW", "fraud", "p2", 7, "m2", "r", 0, None, None),   # same order, other product
        (3, "t", "A", "LOW", "fraud", "p3", None, "m3", "r", 0, None, None),
        (4, "t", "B", "LOW", "fraud", "p1", 7, "m4", "r", 0, None, None),   # other agent
        (5, "t", "A", "LOW", "fraud", None, 0, "m5", "r", 0, None, None)])
    new = alert_frame(spark, [
        (10, "t", "A", "HIGH", "fraud", "px", 7, "n1", "r", 0, None, None),
        (11, "t", "A", "HIGH", "fraud", "p3", 0, "n2", "r", 0, None, None),     # order 0 falls to product
        (12, "t", "A", "HIGH", "fraud", "", None, "m5", "r", 0, None, None),    # message key
        (13, "t", "A", "HIGH", "fraud", "p3", None, "n3", "r", 0, None, None)])  # same product key, later id wins
    got = sorted(r["id"] for r in sinks.insert_alerts_keyed(base, new, "id").collect())
    assert got == [4, 10, 12, 13]


def test_replace_groups_and_empty_batch(spark):
    base = alert_frame(spark, [(1, "t", "A", "LOW", "x", None, 1, "m", "r", 0, None, None),
                               (2, "t", "B", "LOW", "x", None, 2, "m", "r", 0, None, None)])
    new = alert_frame(spark, [(3, "t", "A", "HIGH", "x", None, 3, "m", "r", 0, None, None)])
    assert sorted(r["id"] for r in sinks.replace_alert_groups(base, new).collect()) == [2, 3]
    assert sinks.replace_alert_groups(base, new.limit(0)).count() == 2


def test_conflicts_rules_and_rerun_stability(spark):
    base = alert_frame(spark, [
        (1, "t", "InventoryAgent", "CRITICAL", "inventory", "p1", None, "m", "r", 0, "critical", None),
        (2, "t", "DemandAgent", "MEDIUM", "demand", "p1", None, "Demand decline ...", "r", 0, None, "decline"),
        (3, "t", "InventoryAgent", "LOW", "inventory", "p2", None, "m", "r", 0, None, None),
        (4, "t", "DemandAgent", "MEDIUM", "demand", "p2", None, "m", "r", 0, None, "decline"),
        (5, "t", "DeliveryAgent", "HIGH", "delivery", "p3", 9, "m", "r", 0, None, None),
        (6, "t", "InventoryAgent", "HIGH", "inventory", "p3", None, "m", "r", 0, None, None),
        (7, "t", "FraudAgent", "HIGH", "fraud", "p4", 9, "m", "r", 0, None, None)])
    c = conflicts.resolve_conflicts(base, TS)
    got = {(r["product_name"], r["order_id"]): (r["severity"], r["action"]) for r in c.collect()}
    assert got == {("p1", None): ("HIGH", "partial_reorder"), ("p2", None): ("MEDIUM", "defer"),
                   ("p3", None): ("HIGH", "compound"), (None, 9): ("CRITICAL", "block")}
    esc = c.where("order_id = 9").first()["message"]
    assert "agents=DeliveryAgent" in esc and "categories=delivery" in esc
    again = conflicts.resolve_conflicts(base.unionByName(c), TS)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, c.collect()))


def test_briefing_tiers(spark):
    rows = [(i, "t", "A", s, "fraud", None, i, "x" * 250, "r", 0, None, None)
            for i, s in enumerate(["HIGH", "HIGH", "CRITICAL", "MEDIUM", "HIGH", "HIGH", "HIGH"])]
    b = conflicts.briefing(alert_frame(spark, rows), 5).collect()
    assert [r["severity"] for r in b] == ["CRITICAL", "HIGH", "HIGH", "HIGH", "HIGH"]
    assert len(b[0]["issue"]) == 203


def test_risk_tiers_partition_rows(spark):
    df = spark.range(0, 1000).select((F.col("id") / 1000.0).alias("risk_prob"))
    t = reports.risk_tiers(df).first()
    assert t["critical"] + t["high"] + t["medium"] == 1000
    h = reports.risk_histogram(df)
    assert h.agg(F.sum("n")).first()[0] == 1000 and h.agg(F.max("bin")).first()[0] == 20
