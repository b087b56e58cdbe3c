import tempfile

from pyspark.sql import functions as F

from supplyscope.operators import models, sampling
from supplyscope.operators.sinks import TableStore
from supplyscope.plans.context import Run
from supplyscope.schemas import ALERTS, PREDICTIONS


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0
    assert "severity" in df.columns and "stock_status" in df.columns


def test_registry_shapes():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) > 80


def test_predictions_schema_range_determinism(spark, sf_small):
    r = Run(spark, sf_small, materialize=False)
    p = r.delivery_preds
    assert [f.name for f in p.schema.fields] == [f.name for f in PREDICTIONS.fields]
    assert p.where(~F.col("predicted_value").between(0.6, 1.0)).count() == 0
    a = sorted(map(tuple, p.collect()))
    b = sorted(map(tuple, Run(spark, sf_small, materialize=False).delivery_preds.collect()))
    assert a == b


def test_seasonal_forecast_bounds(spark, sf_small):
    r = Run(spark, sf_small, materialize=False)
    f = models.seasonal_forecast(r.weekly)
    rows = f.collect()
    assert all(x["yhat"] >= 0 and x["ci"] >= 0 for x in rows)
    per = f.groupBy("product_name").count().collect()
    assert all(x["count"] == 8 for x in per)


def test_stratified_quota_and_sample(spark, sf_small):
    r = Run(spark, sf_small, materialize=False)
    s = sampling.stratified_sample(r.items, target=400)
    fraud = r.items.where("order_status = 'SUSPECTED_FRAUD'").count()
    assert s.where("order_status = 'SUSPECTED_FRAUD'").count() == fraud
    assert s.count() == s.dropDuplicates(["item_seq"]).count()
    s1 = sampling.fraud_plus_sample(r.items, cap=100)
    assert s1.count() == fraud + 100


def test_store_round_trip(spark, sf_small):
    """DQ5: insert -> visible; resolve -> flagged and gone from the open list."""
    root = tempfile.mkdtemp(prefix="supplyscope-store-", dir="/tmp")
    st = TableStore(spark, root)
    st.create_tables()
    assert st.exists("alerts") and st.read("alerts").count() == 0
    new = spark.createDataFrame([(1, "t", "T", "LOW", "test", "p", None, "m", "r", 0, "a", "decline")], ALERTS)
    st.write_alerts(new)
    assert st.read("alerts").where("category = 'test'").count() == 1
    st.resolve_alerts(new.select("id"))
    a = st.read("alerts")
    assert a.where("id = 1").first()["is_resolved"] == 1
    assert a.first()["direction"] == "decline"
    assert a.where("is_resolved = 0 AND category = 'test'").count() == 0
    # a later run that raises the same alert finds it open again
    st.clear_alerts()
    st.write_alerts(new.withColumn("created_at", F.lit("t2")))
    assert st.read("alerts").first()["is_resolved"] == 0
    st.resolve_alerts(new.select("id"))
    st.write_alerts(new.withColumn("created_at", F.lit("t3")))
    assert st.read("alerts").first()["is_resolved"] == 0
    st.delete_where("alerts", F.col("category") == "test")
    assert st.read("alerts").count() == 0


def test_every_critical_product_gets_an_alert(spark):
    """300 products, the last 50 by name critical: 50 alerts."""
    from supplyscope.operators import alerts
    from supplyscope.schemas import INVENTORY
    preds = spark.range(300).select(
        F.col("id"), F.lit("t").alias("created_at"), F.lit("inventory").alias("prediction_type"),
        F.format_string("p%03d", "id").alias("product_name"), F.lit(None).cast("long").alias("order_id"),
        F.lit(0.0).alias("predicted_value"), F.lit(0.0).alias("confidence_score"),
        F.when(F.col("id") >= 250, "critical").otherwise("safe").alias("label"))
    out = alerts.inventory_alerts(preds, spark.createDataFrame([], INVENTORY), "t")
    assert out.count() == 50 and out.select("id").distinct().count() == 50


def test_learned_models_are_reused_and_reruns_append_nothing(spark, sf_small, monkeypatch):
    from supplyscope.plans.pipeline import run_pipeline
    monkeypatch.setitem(models.FOREST_PARAMETERS, "num_trees", 12)
    monkeypatch.setitem(models.BOOST_PARAMETERS, "rounds", 2)
    root = tempfile.mkdtemp(prefix="supplyscope-learned-", dir="/tmp")
    first = run_pipeline(spark, sf_small, root=root, run_ts="2026-01-01T00:00:00", learned_models=True)
    st = TableStore(spark, root)
    n = st.read("predictions").count()
    alerts_before = st.read("alerts").count()
    fits = []
    monkeypatch.setattr(models, "train_delivery_forest", lambda *a, **k: fits.append("forest"))
    monkeypatch.setattr(models, "train_inventory_boosted", lambda *a, **k: fits.append("boosted"))
    run_pipeline(spark, sf_small, root=root, run_ts="2026-01-02T00:00:00", learned_models=True)
    p = st.read("predictions")
    assert fits == [] and p.count() == n
    assert [r.created_at for r in p.select("created_at").distinct().collect()] == ["2026-01-01T00:00:00"]
    assert st.read("alerts").count() == alerts_before and first["failed_agents"] == []
    d = p.where("prediction_type = 'delivery'")
    assert d.where("predicted_value < 0.6").count() == 0 and d.select("predicted_value").distinct().count() > 10
    report = st.read("delivery_report").collect()
    assert {r["class"] for r in report} == {0, 1} and all(r["accuracy"] > 0.5 for r in report)


def test_agent_alert_ids_are_unique(spark, sf_small):
    a = Run(spark, sf_small).all_alerts
    assert a.count() == a.select("id").distinct().count()


def test_pipeline_end_to_end(spark, sf_small):
    from supplyscope.plans.pipeline import run_pipeline
    root = tempfile.mkdtemp(prefix="supplyscope-run-", dir="/tmp")
    out = run_pipeline(spark, sf_small, root=root, run_ts="2026-01-01T00:00:00")
    assert out["failed_agents"] == []
    st = TableStore(spark, root)
    cats = {r["category"] for r in st.read("alerts").select("category").distinct().collect()}
    assert {"fraud", "delivery"} <= cats
    q = out["quality"].first()
    assert q["total"] > 10
    assert out["briefing"].count() <= 5


def test_model_save_and_reload(spark, sf_small):
    """MLD8: a saved tree reloads and predicts the same classes."""
    r = Run(spark, sf_small, materialize=False)
    m = models.train_inventory_tree(r.inventory)
    path = models.save_model(m, tempfile.mkdtemp(prefix="supplyscope-model-", dir="/tmp") + "/tree")
    m2 = models.load_tree(path)
    a = sorted(map(tuple, models.inventory_model_predictions(m, r.inventory, "t").collect()))
    b = sorted(map(tuple, models.inventory_model_predictions(m2, r.inventory, "t").collect()))
    assert a == b


def test_missing_access_log_is_empty(spark, sf_small):
    """SRC2: an absent log file gives an empty frame of the log schema."""
    from supplyscope.operators import tables
    from supplyscope.sources import tables as src
    back = src.read_access_log(spark, sf_small + "/no_such_access_log.csv")
    assert back.count() == 0 and "Category" in back.columns
    assert tables.browse_signals(back, "Category", "category").count() == 0
