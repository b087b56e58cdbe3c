"""Flagship query: next-week demand per product against its baseline, with
severity, joined to the product's stock status (AGG3 -> AGG13 + MLD4b ->
JON1 -> AGT5 outcome, left join AGG1/PRJ29)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyscope.functions.columns import dec_round
from supplyscope.operators import alerts, models, tables
from supplyscope.plans.context import RUN_TS, Run


def demand_vs_stock_frames(run: Run) -> DataFrame:
    preds = models.demand_predictions(models.linear_forecast(run.weekly), run.run_ts)
    o = alerts.demand_outcomes(preds, tables.demand_baseline(run.weekly))
    inv = run.inventory.select("product_name", "status", "days_remaining", "simulated_stock")
    sev = F.when(F.col("outcome") == "surge", "HIGH").when(F.col("outcome") == "decline", "MEDIUM")\
        .otherwise("NONE")
    return o.join(inv, "product_name", "left").select(
        "product_name", "week", "forecast", "ci", "baseline", dec_round("ratio", 4).alias("ratio"),
        "outcome", sev.alias("severity"), F.col("status").alias("stock_status"), "days_remaining",
        "simulated_stock")


def demand_vs_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand_vs_stock_frames(Run(spark, sf_dir, RUN_TS, materialize=False))
