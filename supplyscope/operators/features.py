"""Feature engineering on order items (PRJ9-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope.functions.columns import dec_round, season_of
from supplyscope.operators.ranks import exact_quantile


def add_calendar(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    """PRJ9/PRJ10: year, month, ISO week, weekday (Mon = 0), season 1-4."""
    d = F.col(date_col)
    return df.withColumns({
        "order_year": F.year(d).cast("int"),
        "order_month": F.month(d).cast("int"),
        "order_week": F.weekofyear(d).cast("int"),
        "order_dayofweek": F.weekday(d).cast("int"),
    }).withColumn("order_season", season_of("order_month"))


def add_delay(df: DataFrame) -> DataFrame:
    """PRJ11: shipping delay = real - scheduled days."""
    return df.withColumn("delay_days", (F.col("days_real") - F.col("days_scheduled")).cast("double"))


def add_fraud_label(df: DataFrame) -> DataFrame:
    """PRJ12."""
    return df.withColumn("fraud_label", (F.col("order_status") == "SUSPECTED_FRAUD").cast("int"))


def add_profit_margin(df: DataFrame) -> DataFrame:
    """PRJ13: profit / sales * 100, 4 dp; 0 when sales is 0."""
    m = F.when(F.col("sales") != 0, F.col("profit") / F.col("sales") * 100).otherwise(F.lit(0.0))
    return df.withColumn("profit_margin", dec_round(m, 4))


def add_discount_amount(df: DataFrame) -> DataFrame:
    """PRJ14: unit price x discount rate (exact on 2-dp inputs), 4 dp."""
    amt = F.col("product_price").cast("decimal(18,2)") * F.col("discount_rate").cast("decimal(8,4)")
    return df.withColumn("discount_amount", F.round(amt, 4).cast("double"))


def add_high_value(df: DataFrame, q: float = 0.75, threshold: float | None = None) -> DataFrame:
    """PRJ15: sales >= the q-quantile of sales (linear interpolation).

    The exact quantile is fitted first, unless given as ``threshold``; its
    single value is sent to every task.
    """
    cut = exact_quantile(df, "sales", q) if threshold is None else F.lit(threshold)
    return df.withColumn("is_high_value", (F.col("sales") >= cut).cast("int"))


def row_features(items: DataFrame) -> DataFrame:
    """The per-row features (PRJ9-14): one projection, no aggregate."""
    df = add_calendar(items)
    df = add_delay(df)
    df = add_fraud_label(df)
    df = add_profit_margin(df)
    return add_discount_amount(df)


def featurize(items: DataFrame) -> DataFrame:
    """All order-item features: row features plus the high-value flag,
    whose quantile needs the whole column (PRJ15)."""
    return add_high_value(row_features(items))
