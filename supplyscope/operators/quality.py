"""Data-quality checks as one-row-per-check frames (DQ1-8).

Every check is a (check, passed, detail) row built from aggregates over
whole tables; the summary (DQ8) unites them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope.schemas import PREDICTION_TYPES, SEVERITIES

# Minimum rows per table.
MIN_ROWS = {"orders": 5000, "inventory": 100, "weekly_demand": 1000, "predictions": 5000, "alerts": 20}
# Allowed labels per prediction type.
LABELS = {"delivery": ("late", "on_time"), "inventory": ("safe", "low", "critical")}
INVENTORY_REQUIRED = ("product_name", "simulated_stock", "avg_daily_demand", "days_remaining", "status")


def _check(df: DataFrame, name: str, passed, detail) -> DataFrame:
    return df.select(F.lit(name).alias("check"), passed.alias("passed"),
                     detail.cast("string").alias("detail"))


def min_rows(tables: dict) -> DataFrame:
    """DQ1: rows per table against the minimum."""
    parts = []
    for name, df in tables.items():
        m = MIN_ROWS.get(name, 0)
        n = F.count(F.lit(1))
        parts.append(df.select(F.lit(f"rows:{name}").alias("check"), (n >= m).alias("passed"),
                               F.concat(n.cast("string"), F.lit(f" >= {m}")).alias("detail")))
    return reduce(DataFrame.unionByName, parts)


def summary_sanity(orders: DataFrame, alerts: DataFrame, inventory: DataFrame) -> DataFrame:
    """DQ2: totals > 0, fraud < total, counts >= 0."""
    s = orders.select(F.count(F.lit(1)).alias("t"), F.count_if(F.col("fraud_label") == 1).alias("f"))
    o = alerts.select(F.count_if(F.col("is_resolved") == 0).alias("o"))
    c = inventory.select(F.count_if(F.col("status") == "CRITICAL").alias("c"))
    return reduce(DataFrame.unionByName, [
        _check(s, "summary:orders>0", F.col("t") > 0, F.col("t")),
        _check(s, "summary:fraud<total", (F.col("f") >= 0) & (F.col("f") < F.col("t")), F.col("f")),
        _check(o, "summary:open_alerts>=0", F.col("o") >= 0, F.col("o")),
        _check(c, "summary:critical_stock>=0", F.col("c") >= 0, F.col("c")),
    ])


def prediction_checks(predictions: DataFrame, types=("delivery", "inventory")) -> DataFrame:
    """DQ3: labels within the type's domain, value not NULL, delivery
    score within [0, 1]."""
    parts = []
    for t in types:
        p = predictions.where(F.col("prediction_type") == t)
        bad = F.count_if(~F.col("label").isin(*LABELS[t]) | F.col("label").isNull())
        parts.append(_check(p.select(bad.alias("b")), f"predictions:{t}:labels", F.col("b") == 0, F.col("b")))
        nul = F.count_if(F.col("predicted_value").isNull())
        parts.append(_check(p.select(nul.alias("b")), f"predictions:{t}:values", F.col("b") == 0, F.col("b")))
    d = predictions.where(F.col("prediction_type") == "delivery")
    out = F.count_if(~F.col("confidence_score").between(0.0, 1.0))
    parts.append(_check(d.select(out.alias("b")), "predictions:delivery:score_range", F.col("b") == 0, F.col("b")))
    known = F.count_if(~F.col("prediction_type").isin(*PREDICTION_TYPES))
    parts.append(_check(predictions.select(known.alias("b")), "predictions:types", F.col("b") == 0, F.col("b")))
    return reduce(DataFrame.unionByName, parts)


def alert_coverage(alerts: DataFrame, categories=("fraud", "delivery", "inventory", "demand", "conflict"),
                   required=("fraud", "delivery", "inventory")) -> DataFrame:
    """DQ4: open / resolved alerts per category (left join to the category
    list), severities within the domain, ids that occur once."""
    spark = alerts.sparkSession
    cats = spark.createDataFrame([(c,) for c in categories], "category string")
    g = alerts.groupBy("category").agg(F.count_if(F.col("is_resolved") == 0).alias("open"),
                                       F.count_if(F.col("is_resolved") == 1).alias("resolved"))
    j = cats.join(g, "category", "left").fillna(0, subset=["open", "resolved"])
    cov = j.select(F.concat(F.lit("alerts:"), F.col("category")).alias("check"),
                   (~F.col("category").isin(*required) | (F.col("open") + F.col("resolved") > 0)).alias("passed"),
                   F.concat(F.col("open").cast("string"), F.lit(" open / "),
                            F.col("resolved").cast("string"), F.lit(" resolved")).alias("detail"))
    bad = alerts.select(F.count_if(~F.col("severity").isin(*SEVERITIES)).alias("b"))
    # an id per group first, so that no task holds all distinct ids
    again = alerts.groupBy("id").agg((F.count(F.lit(1)) - 1).alias("more")).select(F.coalesce(F.sum("more"), F.lit(0)).alias("b"))
    return (cov.unionByName(_check(bad, "alerts:severity_domain", F.col("b") == 0, F.col("b")))
            .unionByName(_check(again, "alerts:unique_ids", F.col("b") == 0, F.col("b"))))


def inventory_checks(inventory: DataFrame) -> DataFrame:
    """DQ6: required columns, no NULL names, no negative stock, status
    counts add up to the total."""
    missing = [c for c in INVENTORY_REQUIRED if c not in inventory.columns]
    one = inventory.select(F.count(F.lit(1)).alias("n"))
    parts = [_check(one, "inventory:columns", F.lit(not missing), F.lit(",".join(missing) or "ok"))]
    if not missing:
        s = inventory.select(F.count(F.lit(1)).alias("n"),
                             F.count_if(F.col("product_name").isNull()).alias("nul"),
                             F.count_if(F.col("simulated_stock") < 0).alias("neg"))
        by = inventory.groupBy("status").agg(F.count(F.lit(1)).alias("c")).select(F.sum("c").alias("sum_c"))
        parts += [
            _check(s, "inventory:names", F.col("nul") == 0, F.col("nul")),
            _check(s, "inventory:stock>=0", F.col("neg") == 0, F.col("neg")),
            _check(s, "inventory:status_total", F.col("n") == by.select("sum_c").scalar(), F.col("n")),
        ]
    return reduce(DataFrame.unionByName, parts)


def search_checks(orders: DataFrame, hit: str, miss: str) -> DataFrame:
    """DQ7: a known word finds rows, a nonsense word none, 21 columns."""
    from supplyscope.operators.reports import search_orders
    from supplyscope.plans.catalog import orders_table
    h = search_orders(orders, hit).select(F.count(F.lit(1)).alias("n"))
    m = search_orders(orders, miss).select(F.count(F.lit(1)).alias("n"))
    width = len(orders_table(orders).columns)
    return reduce(DataFrame.unionByName, [
        _check(h, "search:hit", F.col("n") > 0, F.col("n")),
        _check(m, "search:miss", F.col("n") == 0, F.col("n")),
        _check(h, "search:width", F.lit(width == 21), F.lit(width)),
    ])


def check_summary(checks: DataFrame) -> DataFrame:
    """DQ8: passed, failed, total, percent, names of the failed checks
    (bounded by the number of checks)."""
    return checks.select(
        F.count_if(F.col("passed")).alias("passed"), F.count_if(~F.col("passed")).alias("failed"),
        F.count(F.lit(1)).alias("total"),
        F.round(F.count_if(F.col("passed")) / F.greatest(F.count(F.lit(1)), F.lit(1)) * 100, 1).alias("percent"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("check")))), ", ").alias("failures"))
