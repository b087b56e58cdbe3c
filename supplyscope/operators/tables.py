"""Derived tables: inventory, weekly demand, browse signals
(AGG1-4, AGG13-14, PRJ22, PRJ29, PRJ32-35, WIN1-2, SMP4, TOP9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplyscope.functions.columns import (dec_bround, stock_status, strip_lower, supply_days,
                                           week_monday)
from supplyscope.operators.ranks import text_rank


def span_days(items: DataFrame, col: str = "order_date") -> Column:
    """AGG2: whole 24-hour periods between first and last order, at least 1
    (a scalar subquery)."""
    return items.select(F.greatest(
        F.timestamp_diff("DAY", F.min(col), F.max(col)), F.lit(1)).alias("d")).scalar()


def inventory_base(items: DataFrame) -> DataFrame:
    """AGG1: per product sum / count / mean of quantity; price, category and
    department of the first line in file order (``min_by`` item_seq).

    One pass over the order lines.  ``min_by`` over a struct has a
    variable-width buffer, so Spark runs this aggregate sort-based (a
    spill-safe per-partition sort by product, partial aggregation before the
    shuffle).  A hash-only variant needs a second pass (smallest order id
    per product, then a filtering join), and since the branches prune
    different columns Spark cannot reuse the join's shuffles between them:
    measured, it ran the three-way join three times.  One sort is cheaper.
    """
    return items.groupBy("product_name").agg(
        F.sum("quantity").cast("bigint").alias("total_sold"),
        F.count(F.lit(1)).alias("total_orders"),
        F.avg("quantity").alias("avg_per_order"),
        F.min_by(F.struct("product_price", "category", "department"), "item_seq").alias("_first"),
    ).select("product_name", "total_sold", "total_orders", "avg_per_order",
             "_first.product_price", "_first.category", "_first.department")


def build_inventory(items: DataFrame) -> DataFrame:
    """Inventory table: AGG1 + AGG2 + SMP4 + PRJ29 + PRJ32 (daily demand),
    PRJ33 (reorder threshold), PRJ34 (stock on hand), PRJ35 (days remaining).

    One shuffle (the product aggregate); the span is a scalar subquery.
    """
    days = span_days(items)
    inv = inventory_base(items)
    add = dec_bround(F.col("total_sold") / days, 4)
    inv = inv.withColumns({
        "avg_daily_demand": add,
        "reorder_threshold": dec_bround(F.col("avg_per_order") * 7, 2),
        "_supply": supply_days("product_name"),
    })
    stock = F.greatest(
        F.bround(F.col("avg_daily_demand").cast("decimal(20,4)") * F.col("_supply"), 0).cast("bigint"),
        F.lit(1).cast("bigint"))
    inv = inv.withColumn("simulated_stock", stock)
    inv = inv.withColumn("days_remaining", F.when(
        F.col("avg_daily_demand") > 0,
        dec_bround(F.col("simulated_stock") / F.col("avg_daily_demand"), 1)).otherwise(F.lit(999.0)))
    inv = inv.withColumn("status", stock_status("days_remaining"))
    return inv.select("product_name", "total_sold", "total_orders", "avg_per_order",
                      "product_price", "category", "department", "simulated_stock",
                      "reorder_threshold", "avg_daily_demand", "days_remaining", "status")


WEEK_KEYS = ("product_name", "category", "market", "order_year", "order_week", "order_month",
             "order_season")


def weekly_demand(features: DataFrame) -> DataFrame:
    """AGG3 + WIN1 + PRJ22: weekly rows per (product, category, market,
    year, week, month, season) with sums, count, lags and the Monday key.

    lag_1/lag_2 follow the row order (year, week, category, market, month,
    season) within the product, default 0.  The aggregate shuffles on the
    group keys; the window then re-partitions the (much smaller) weekly
    rows by product.
    """
    wk = features.groupBy(*WEEK_KEYS).agg(
        F.sum("quantity").cast("bigint").alias("weekly_qty"),
        F.sum(F.col("sales").cast("decimal(18,2)")).cast("double").alias("weekly_sales"),
        F.count(F.lit(1)).alias("weekly_orders"),
    )
    w = Window.partitionBy("product_name").orderBy(
        "order_year", "order_week", "category", "market", "order_month", "order_season")
    return wk.withColumns({
        "lag_1": F.lag("weekly_qty", 1, 0).over(w),
        "lag_2": F.lag("weekly_qty", 2, 0).over(w),
        "ds": week_monday("order_year", "order_week"),
    })


def weekly_true_week(features: DataFrame) -> DataFrame:
    """WIN1, true-week form: one row per (product, Monday of the order's
    week) with lags by week, not by row."""
    wk = (features.withColumn("week_start", F.date_trunc("week", "order_date").cast("date"))
          .groupBy("product_name", "week_start")
          .agg(F.sum("quantity").cast("bigint").alias("weekly_qty")))
    w = Window.partitionBy("product_name").orderBy("week_start")
    return wk.withColumns({"lag_1": F.lag("weekly_qty", 1, 0).over(w),
                           "lag_2": F.lag("weekly_qty", 2, 0).over(w)})


def weekly_table(weekly: DataFrame) -> DataFrame:
    """SNK5 projection: the stored five-column weekly_demand table."""
    return weekly.select(
        "product_name", F.col("order_year").alias("year"), F.col("order_week").alias("week"),
        F.col("weekly_qty").cast("double").alias("total_quantity"),
        F.col("weekly_sales").alias("total_sales"))


def demand_baseline(weekly: DataFrame) -> DataFrame:
    """AGG13: mean weekly quantity per product (per weekly row), 1 dp."""
    return weekly.groupBy("product_name").agg(
        dec_bround(F.avg("weekly_qty"), 1).alias("baseline"))


def global_weekly(weekly: DataFrame) -> DataFrame:
    """AGG14: total weekly quantity over all products per week key."""
    return weekly.groupBy("ds").agg(F.sum("weekly_qty").cast("bigint").alias("y"))


def browse_signals(log: DataFrame, col: str, name: str) -> DataFrame:
    """AGG4 + PRJ21 + WIN2: normalised value, browse count, rank 1..n by
    count desc then name.

    A value's rank is the number of values with a greater count (a window over
    the distinct counts, about the square root of the events at most) plus its
    rank by name among those with its own count."""
    counts = (log.select(strip_lower(col).alias(name)).where(F.col(name).isNotNull())
              .groupBy(name).agg(F.count(F.lit(1)).alias("browse_count")))
    sizes = counts.groupBy("browse_count").agg(F.count(F.lit(1)).alias("_n"))
    above = Window.orderBy(F.desc("browse_count")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_above", F.coalesce(F.sum("_n").over(above), F.lit(0))).drop("_n")
    ranked = text_rank(counts, ["browse_count"], name, "_own").join(sizes, "browse_count")
    return ranked.select(name, "browse_count", (F.col("_above") + F.col("_own") + 1).cast("int").alias("browse_rank"))


def top_browsed(signals: DataFrame, n: int = 5) -> DataFrame:
    """TOP9."""
    return signals.where(F.col("browse_rank") <= n)


def browse_join(inventory: DataFrame, cat_signals: DataFrame) -> DataFrame:
    """JON8: a product's category joined to its browse rank (left)."""
    s = cat_signals.select(F.col("category").alias("_bc"), "browse_count", "browse_rank")
    return inventory.join(s, strip_lower("category") == F.col("_bc"), "left").drop("_bc")
