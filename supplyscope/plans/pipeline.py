"""End-to-end batch run (AGT10 and the preprocessing / model / load steps).

One function, each step a DataFrame job; tables land in a ``TableStore``
under the shared folder.  An agent that fails is reported and the others
still run (the reference's behaviour), without stopping the run.
"""

from __future__ import annotations

import datetime as _dt
import logging

from pyspark.sql import DataFrame, SparkSession

from supplyscope.operators import alerts, conflicts, encode, models, quality, reports, tables
from supplyscope.operators.boosting import Boosted
from supplyscope.operators.forest import BINS
from supplyscope.operators.reuse import Records, content_digest, step_key
from supplyscope.operators.sinks import TableStore
from supplyscope.plans.catalog import orders_table
from supplyscope.plans.context import Run
from supplyscope.session import output_root
from supplyscope.sources import tables as src

log = logging.getLogger("supplyscope")


ENCODED = ["shipping_mode", "market", "customer_segment", "department"]


def _learned_predictions(store: TableStore, run: Run, records: Records, digests: dict) -> tuple[DataFrame, dict]:
    """MLD1-2, MLD6-8: predictions of the learned models by type, and the key
    of each.  Models of the same input, features and parameters are used again;
    for new ones label codes, held-out reports and importances are stored."""
    spark = run.spark
    forest_key = step_key("delivery_forest", digests["lines"], models.DELIVERY_FEATURES, models.FOREST_PARAMETERS | {"bins": BINS})
    boost_key = step_key("inventory_boosted", digests["inventory"], models.INVENTORY_FEATURES, models.BOOST_PARAMETERS)
    codes, _ = records.model("label_codes", step_key("label_codes", digests["lines"], ENCODED, {}), run.run_ts, spark.read.parquet,
                             lambda: encode.fit_label_codes(run.feats, ENCODED), lambda m, path: m.write.parquet(path))
    if codes.isEmpty():
        raise ValueError("stored label codes are empty")
    encoded = encode.apply_label_codes(run.feats, codes, ENCODED)
    forest, old = records.model("delivery_forest", forest_key, run.run_ts, models.load_forest,
                                lambda: models.train_delivery_forest(encoded, **models.FOREST_PARAMETERS)[0], models.save_model)
    if not old:
        store.overwrite("feature_importance", models.feature_importances(spark, forest))
        store.overwrite("delivery_report", models.delivery_held_out(forest, models.split_lines(encoded)))
    split = models.split_products(run.inventory)
    boosted, old = records.model("inventory_boosted", boost_key, run.run_ts, lambda path: Boosted.load(spark, path),
                                 lambda: models.train_inventory_boosted(split, **models.BOOST_PARAMETERS),
                                 lambda m, path: m.save(spark, path))
    if not old:
        store.overwrite("inventory_report", models.inventory_held_out(boosted, split))
    return {"delivery": models.delivery_predictions(models.score_delivery(forest, encoded), run.run_ts),
            "inventory": models.inventory_model_predictions(boosted, run.inventory, run.run_ts),
            "demand": run.demand_preds}, {"delivery": forest_key, "inventory": boost_key, "demand": "linear"}


def _stored_predictions(store: TableStore, run: Run, records: Records, learned: bool) -> DataFrame:
    """SNK6 + SNK13: this input's predictions, appended unless an earlier run
    of the same input, features and parameters has stored them."""
    digests = {"lines": content_digest(run.feats, [c for c in run.feats.columns if c != "item_seq"]),
               "inventory": content_digest(run.inventory, run.inventory.columns)}
    if learned:
        frames, keys = _learned_predictions(store, run, records, digests)
    else:
        frames = {"delivery": run.delivery_preds, "inventory": run.inventory_preds, "demand": run.demand_preds}
        keys = dict.fromkeys(frames, "rule")
    stamps = {}
    for kind, frame in frames.items():
        key = step_key(f"{kind}_predictions", digests["lines"], [], {"model": keys[kind]})
        stamps[kind], skipped = records.rows(f"{kind}_predictions", key, run.run_ts, lambda f=frame: store.append("predictions", f))
        log.info("%s predictions: %s", kind, "stored by an earlier run" if skipped else "stored")
    return run.cut(records.stored(store.read("predictions"), stamps), "stored_predictions")


def run_pipeline(spark: SparkSession, sf_dir: str, root: str | None = None,
                 run_ts: str | None = None, learned_models: bool = False) -> dict:
    """Build every table of a run and return the summary frames.

    Steps: order lines -> features -> orders / inventory / weekly tables
    -> browse signals -> predictions -> clear alerts -> four agents
    (each replaces its own (agent, category) group) -> conflicts ->
    briefing, alert summary and data-quality report.

    A rerun on the same input, features and parameters appends no predictions
    and refits no model (``operators.reuse``); what changed is made anew.
    ``learned_models`` scores lines with the forest and products with the
    boosted trees.
    """
    run_ts = run_ts or _dt.datetime.now().replace(microsecond=0).isoformat()
    root = root or output_root(spark, "tables")
    store = TableStore(spark, root)
    store.create_tables()
    run = Run(spark, sf_dir, run_ts=run_ts)

    store.overwrite("orders", orders_table(run.flagged))
    store.upsert("inventory", run.inventory, ["product_name"])
    store.overwrite("weekly_demand", tables.weekly_table(run.weekly))
    store.overwrite("weekly_demand_features", run.weekly)
    log_ = src.browse_log(spark, sf_dir)
    store.overwrite("browse_category", tables.browse_signals(log_, "Category", "category"))
    store.overwrite("browse_department", tables.browse_signals(log_, "Department", "department"))

    preds = _stored_predictions(store, run, Records(spark, root), learned_models)

    store.clear_alerts()
    jobs = {
        "FraudAgent": lambda: alerts.fraud_alerts(run.feats, run_ts),
        "DeliveryAgent": lambda: alerts.delivery_alerts(preds, run.feats, run_ts),
        "InventoryAgent": lambda: alerts.inventory_alerts(preds, run.inventory, run_ts),
        "DemandAgent": lambda: alerts.demand_alerts(preds, run.baseline, run_ts),
    }
    failed = []
    for name, job in jobs.items():
        try:
            store.write_alerts(job())
        except Exception as e:  # noqa: BLE001 - one agent must not stop the others
            log.error("agent %s failed: %s", name, e)
            failed.append(name)
    stored = store.read("alerts")
    store.write_alerts(conflicts.resolve_conflicts(stored, run_ts))
    final = store.read("alerts")

    checks = (quality.min_rows({n: store.read(n) for n in ("orders", "inventory", "weekly_demand",
                                                            "predictions", "alerts")})
              .unionByName(quality.summary_sanity(store.read("orders"), final, store.read("inventory")))
              .unionByName(quality.prediction_checks(preds))
              .unionByName(quality.alert_coverage(final))
              .unionByName(quality.inventory_checks(store.read("inventory"))))
    store.overwrite("quality_checks", checks)
    return {
        "root": root,
        "failed_agents": failed,
        "briefing": conflicts.briefing(final, 5),
        "alert_summary": reports.open_alert_pivot(final),
        "quality": quality.check_summary(store.read("quality_checks")),
    }
