"""One run's shared frames, built once and reused by every job of the run.

Some frames feed many later jobs, so each is written once as a parquet
table in the shared folder (next to ``spark.checkpoint.dir``) and read
back: the featurised order lines (the big one: the three-way join is paid
once, and every consumer reads only its columns), inventory and weekly demand,
the predictions, the agent alerts and the conflict alerts.  Lineage is cut at each, plans stay small,
and a lost executor re-reads a file instead of recomputing the joins.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyscope.operators import alerts, conflicts, features, models, tables
from supplyscope.operators.ranks import exact_quantiles
from supplyscope.session import configure, output_root, store, written
from supplyscope.sources import tables as src

RUN_TS = "2026-01-01T00:00:00"
MODEL_COLUMNS = ("shipping_mode", "days_scheduled", "market", "customer_segment", "department", "quantity", "sales",
                 "discount_rate", "order_month", "order_dayofweek", "late_delivery_risk")
DRAW_KEYS = ("order_id", "line_number", "part_key", "supp_key")


class Run:
    def __init__(self, spark: SparkSession, sf_dir: str, run_ts: str = RUN_TS,
                 materialize: bool = True):
        self.spark, self.sf_dir, self.run_ts, self.materialize = spark, sf_dir, run_ts, materialize
        self._root = None
        configure(spark)

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        if not self.materialize:
            return df
        if self._root is None:
            self._root = output_root(self.spark, f"runs/{uuid.uuid4().hex}")
        path = f"{self._root}/{name}"
        store(df, path, "zstd")
        return self.spark.read.parquet(path)

    @cached_property
    def items(self) -> DataFrame:
        return src.order_items(self.spark, self.sf_dir)

    @cached_property
    def feats(self) -> DataFrame:
        """Order lines with the per-row features; when materialised, the lines
        are stored, each value once, and readers make the features from their row.
        The high-value flag, whose quantile takes jobs of its own, is added by
        ``flagged`` for those who select it."""
        if not self.materialize:
            return features.row_features(self.items)
        own = [c for c in self.items.columns if c not in ("item_seq", *src.ITEM_SEQ_FIELDS)]
        stored = self.cut(self.items.select("item_seq.*", *own), "order_features")
        return features.row_features(stored.withColumn("item_seq", F.struct(*src.ITEM_SEQ_FIELDS)).select(self.items.columns))

    @cached_property
    def high_value(self) -> float | None:
        """PRJ15: the 0.75-quantile of sales.  The column is written once, so
        the passes over it don't repeat the joins."""
        return exact_quantiles(written(self.feats.select("sales"), "sales"), ["sales"], 0.75)["sales"]

    @property
    def flagged(self) -> DataFrame:
        return features.add_high_value(self.feats, threshold=self.high_value)

    @cached_property
    def draw_lines(self) -> DataFrame:
        """The columns that samples, splits and late scores read, stored: the
        lines are joined once, whatever the number of passes.  Each value is
        stored once; keys and ``item_seq`` are made of the same columns."""
        lines = self.items.select("item_seq.*", "order_status", "late_delivery_risk", "shipping_mode")
        return written(lines, "draw-lines", "zstd").select(
            *DRAW_KEYS, "order_status", "late_delivery_risk", "shipping_mode", F.struct(*src.ITEM_SEQ_FIELDS).alias("item_seq"))

    @cached_property
    def model_lines(self) -> DataFrame:
        """The columns that the delivery forest and its predictions read, stored."""
        lines = features.row_features(self.items).select("item_seq.*", *MODEL_COLUMNS)
        return written(lines, "model-lines", "zstd").withColumn("item_seq", F.struct(*src.ITEM_SEQ_FIELDS))

    @cached_property
    def inventory(self) -> DataFrame:
        """One row a product; stored when materialised, since models read it
        many times."""
        return self.cut(tables.build_inventory(self.feats), "inventory")

    @cached_property
    def weekly(self) -> DataFrame:
        """Weekly demand; stored when materialised: forecast and baseline read it."""
        return self.cut(tables.weekly_demand(self.feats), "weekly")

    @cached_property
    def baseline(self) -> DataFrame:
        return tables.demand_baseline(self.weekly)

    @cached_property
    def rule_scores(self) -> DataFrame:
        return models.delivery_rule_scores(self.feats)

    @cached_property
    def delivery_preds(self) -> DataFrame:
        return models.delivery_predictions(self.rule_scores, self.run_ts)

    @cached_property
    def inventory_preds(self) -> DataFrame:
        return models.inventory_rule_predictions(self.inventory, self.run_ts)

    @cached_property
    def demand_preds(self) -> DataFrame:
        return models.demand_predictions(models.linear_forecast(self.weekly), self.run_ts)

    @cached_property
    def encoded(self) -> DataFrame:
        from supplyscope.operators import encode
        enc, _ = encode.label_encode(self.model_lines, ["shipping_mode", "market", "customer_segment", "department"])
        return enc

    @cached_property
    def forest_and_split(self):
        """MLD1: the delivery forest of this run (trained once) and the rows
        with their side of the split."""
        return models.train_delivery_forest(self.encoded)

    @cached_property
    def boosted_and_split(self):
        """MLD6: the boosted stock classifier of this run (trained once) and
        the products with their side of the split."""
        split = models.split_products(self.inventory)
        return models.train_inventory_boosted(split), split

    @property
    def forest(self):
        return self.forest_and_split[0]

    @cached_property
    def preds(self) -> DataFrame:
        """All predictions of the run: late lines, products and forecast weeks."""
        return self.cut(self.delivery_preds.unionByName(self.inventory_preds)
                         .unionByName(self.demand_preds), "predictions")

    @cached_property
    def agent_alerts(self) -> DataFrame:
        """AGT1-5 united (SET5): every qualifying line, order and product."""
        a = (alerts.fraud_alerts(self.feats, self.run_ts)
             .unionByName(alerts.delivery_alerts(self.preds, self.feats, self.run_ts))
             .unionByName(alerts.inventory_alerts(self.preds, self.inventory, self.run_ts))
             .unionByName(alerts.demand_alerts(self.preds, self.baseline, self.run_ts)))
        return self.cut(a, "agent_alerts")

    @cached_property
    def conflict_alerts(self) -> DataFrame:
        return self.cut(conflicts.resolve_conflicts(self.agent_alerts, self.run_ts), "conflict_alerts")

    @cached_property
    def all_alerts(self) -> DataFrame:
        return self.agent_alerts.unionByName(self.conflict_alerts)


_RUNS: dict = {}


def run_for(spark: SparkSession, sf_dir: str, materialize: bool = True) -> Run:
    """The shared run of (session, input folder).

    ``materialize=True`` (prediction / alert jobs, which read the order
    lines many times) writes the shared tables once; ``False`` (single-pass
    queries) keeps every frame lazy so Catalyst prunes per query."""
    key = (spark.sparkContext.applicationId, sf_dir, materialize)
    if key not in _RUNS:
        _RUNS[key] = Run(spark, sf_dir, materialize=materialize)
    return _RUNS[key]


class NarrowRun(Run):
    """A run that stores nothing but the narrow lines, and scores those."""

    @cached_property
    def rule_scores(self) -> DataFrame:
        return models.delivery_rule_scores(run_for(self.spark, self.sf_dir, materialize=False).draw_lines)


def narrow_run(spark: SparkSession, sf_dir: str) -> Run:
    return NarrowRun(spark, sf_dir, materialize=False)
