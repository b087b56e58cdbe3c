"""Registered queries, part 2: predictions (exact forms + learned forms)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from supplyscope.operators import encode, models, sinks, tables
from supplyscope.operators.reuse import Records, content_digest, step_key
from supplyscope.plans.catalog import KEYS, PRJ19_SQL, feats, inventory, weekly
from supplyscope.plans.context import narrow_run, run_for
from supplyscope.plans.registry import register
from supplyscope.plans.sqlparts import SEQ, SEQ_TEXT, with_
from supplyscope.plans.sqlparts_alerts import PREDS, RUN_TS, hid
from supplyscope.session import output_root, written

PRED_COLS = "id, created_at, prediction_type, product_name, order_id, predicted_value, confidence_score, label"


def delivery_preds(spark, d):
    return run_for(spark, d, materialize=False).delivery_preds


def inventory_preds(spark, d):
    return run_for(spark, d, materialize=False).inventory_preds


def demand_preds(spark, d):
    return run_for(spark, d, materialize=False).demand_preds


def all_preds(spark, d):
    return run_for(spark, d).preds


@register("agg21_late_rate_by_mode", with_(PREDS) + """
SELECT shipping_mode, late_rate, orders FROM rates""")
def q_agg21(spark, d):
    """AGG21: late share per shipping mode (computed, not hard-coded)."""
    return models.mode_late_rates(feats(spark, d))


@register("agg21_late_rate_overall", with_(PREDS) + """
SELECT avg(late_delivery_risk) AS late_rate, count(*) AS orders FROM feat""")
def q_agg21b(spark, d):
    return feats(spark, d).select(F.avg("late_delivery_risk").alias("late_rate"),
                                  F.count(F.lit(1)).alias("orders"))


@register("mld2_delivery_predictions_rule", with_(PREDS) + f"\nSELECT {PRED_COLS} FROM dpred")
def q_dpred(spark, d):
    """FLT7 + MLD2 (rule score): every late score >= 0.60."""
    return delivery_preds(spark, d)


@register("top3_highest_late_scores", with_(PREDS) + f"""
SELECT {', '.join('p.' + c for c in PRED_COLS.split(', '))} FROM dpred p JOIN (
  SELECT {hid("'delivery|' || " + SEQ_TEXT)} AS id FROM scored WHERE late_prob >= 0.6 ORDER BY late_prob DESC, {SEQ} LIMIT 5000) t
ON p.id = t.id""")
def q_top3(spark, d):
    """TOP3: the 5000 highest late scores (ties by item order), over the
    stored narrow lines."""
    return models.delivery_predictions(narrow_run(spark, d).rule_scores, RUN_TS, top=5000)


@register("mld6b_mld7_inventory_predictions", with_(PREDS) + f"\nSELECT {PRED_COLS} FROM ipred")
def q_ipred(spark, d):
    """MLD6b + MLD7: inventory class per product from the stock rule."""
    return inventory_preds(spark, d)


@register("mld4b_demand_forecast", with_(PREDS) + "\nSELECT product_name, ds, yhat, ci FROM fc")
def q_fc(spark, d):
    """MLD4b + FLT10: 8-week linear forecast per product (>= 20 rows)."""
    return models.linear_forecast(weekly(spark, d))


@register("mld4b_demand_predictions", with_(PREDS) + f"\nSELECT {PRED_COLS} FROM mpred")
def q_mpred(spark, d):
    return demand_preds(spark, d)


@register("mld5_global_forecast", with_(PREDS) + """,
gser AS (SELECT ds, date_diff('day', DATE '1970-01-05', ds) / CAST(7.0 AS DOUBLE) AS x,
                CAST(sum(weekly_qty) AS DOUBLE) AS y FROM weekly GROUP BY ds),
gfit AS (SELECT count(*) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, var_pop(y) AS vy,
                var_pop(x) AS vx, avg(y) AS my, max(ds) AS last FROM gser HAVING count(*) >= 20),
gsteps AS (SELECT g.*, t.k, CAST(g.last + CAST(6 + (t.k - 1) * 7 AS INTEGER) AS DATE) AS fds
           FROM gfit g CROSS JOIN range(1, 9) t(k))
SELECT 'ALL' AS series, fds AS ds,
       CAST(ROUND(CAST(greatest(coalesce(a, my) + coalesce(b, 0.0) * (date_diff('day', DATE '1970-01-05', fds) / CAST(7.0 AS DOUBLE)), 0.0) AS DECIMAL(38,10)), 1) AS DOUBLE) AS yhat,
       CAST(ROUND(CAST(greatest(""" + f"CAST({2 * models.BAND_Z!r} AS DOUBLE)" + """ * sqrt(greatest(vy - coalesce(b, 0.0) * coalesce(b, 0.0) * vx, 0.0)), 0.0) AS DECIMAL(38,10)), 1) AS DOUBLE) AS ci
FROM gsteps""")
def q_mld5(spark, d):
    """AGG14 + MLD5: the global weekly series through the same forecast."""
    g = tables.global_weekly(weekly(spark, d)).withColumn("series", F.lit("ALL"))
    return models.linear_forecast(g, key="series", y="y")


@register("jon1_next_week_forecast", with_(PREDS) + """
SELECT p.product_name, p.label, p.predicted_value, p.confidence_score
FROM preds p JOIN (SELECT product_name, min(label) AS ml FROM preds WHERE prediction_type = 'demand'
                   GROUP BY product_name) s ON p.product_name = s.product_name AND p.label = s.ml
WHERE p.prediction_type = 'demand'""")
def q_jon1(spark, d):
    """JON1: row at the per-product minimum week label (ties kept)."""
    return models.next_week_forecast(all_preds(spark, d)).select(
        "product_name", "label", "predicted_value", "confidence_score")


# ---------------------------------------------------------------- reuse

@register("mld8_reuse_label_codes", PRJ19_SQL)
def q_mld8(spark, d):
    """MLD8: a fitted model (label codes) is stored under its input's digest;
    the same input, though its rows come in another order, finds it again, and
    what it gives is what a new fit gives."""
    lines, columns = run_for(spark, d).feats, ["market", "customer_segment"]
    records = Records(spark, output_root(spark, f"records/{uuid.uuid4().hex}"))
    for frame in (lines, lines.repartition(7)):
        key = step_key("label_codes", content_digest(frame, columns), columns, {})
        codes, reused = records.model("label_codes", key, RUN_TS, spark.read.parquet, lambda: encode.fit_label_codes(lines, columns),
                                      lambda m, path: m.write.parquet(path))
    assert reused
    return encode.apply_label_codes(lines, codes, columns).select(*KEYS, "market_enc", "customer_segment_enc")


@register("snk13_rerun_appends_once", with_(PREDS) + f"\nSELECT {PRED_COLS} FROM preds")
def q_snk13_rerun(spark, d):
    """SNK13: predictions of the same input are appended once, however often
    the step runs."""
    run, root = run_for(spark, d), output_root(spark, f"stores/{uuid.uuid4().hex}")
    store, records = sinks.TableStore(spark, root), Records(spark, root)
    digest = content_digest(run.feats, ["order_id", "line_number", "product_name", "sales", "quantity", "late_delivery_risk"])
    for stamp in (RUN_TS, "2026-01-02T00:00:00"):
        for kind in ("delivery", "inventory", "demand"):
            rows = run.preds.where(F.col("prediction_type") == kind)
            records.rows(kind, step_key(kind, digest, [], {}), stamp, lambda r=rows: store.append("predictions", r))
    return store.read("predictions")


# ---------------------------------------------------------------- learned forms (rows checks)

@register("mld1_mld2_delivery_forest")
def q_forest(spark, d):
    """MLD1 + MLD2 + SMP3: random forest (100 trees, depth 10, balanced
    weights) on the hash-split training side, scored on all lines, every
    late score >= 0.60 as a prediction."""
    run = run_for(spark, d)
    return models.delivery_predictions(models.score_delivery(run.forest, run.encoded), RUN_TS)


@register("mld1_agg24_forest_held_out")
def q_forest_report(spark, d):
    """MLD1 + AGG24: the forest's report on the lines it never saw."""
    run = run_for(spark, d)
    return models.delivery_held_out(*run.forest_and_split)


@register("mld6_agg24_tree_held_out")
def q_tree_report(spark, d):
    """MLD6 + AGG24: the stock tree's report on held-out products."""
    split = models.split_products(written(inventory(spark, d), "inventory"))
    return models.inventory_held_out(models.train_inventory_tree(split), split)


@register("mld3_win6_feature_importance")
def q_importance(spark, d):
    """MLD3 + WIN6: ranked importances of the delivery forest."""
    return models.feature_importances(spark, run_for(spark, d).forest)


@register("mld4_seasonal_forecast")
def q_seasonal(spark, d):
    """MLD4: per-product trend + yearly season fit (applyInPandas)."""
    return models.seasonal_forecast(weekly(spark, d))


@register("mld6_inventory_tree")
def q_tree(spark, d):
    """MLD6 + MLD7: decision tree on the inventory features."""
    inv = written(inventory(spark, d), "inventory")
    model = models.train_inventory_tree(inv)
    return models.inventory_model_predictions(model, inv, RUN_TS)


@register("mld6_inventory_boosted")
def q_boosted(spark, d):
    """MLD6 + MLD7: boosted trees (100 rounds, depth 4, rate 0.1) for the
    three stock classes, fitted on the training products, for every product."""
    run = run_for(spark, d)
    return models.inventory_model_predictions(run.boosted_and_split[0], run.inventory, RUN_TS)


@register("mld6_agg24_boosted_held_out")
def q_boosted_report(spark, d):
    """MLD6 + AGG24: the boosted classifier's report on held-out products."""
    return models.inventory_held_out(*run_for(spark, d).boosted_and_split)
