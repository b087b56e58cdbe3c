"""Fixed StructTypes of the five stored tables (checked at scan / write)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("order_date", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("department", T.StringType()),
    T.StructField("market", T.StringType()),
    T.StructField("order_region", T.StringType()),
    T.StructField("customer_segment", T.StringType()),
    T.StructField("sales", T.DoubleType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("profit", T.DoubleType()),
    T.StructField("discount_rate", T.DoubleType()),
    T.StructField("shipping_mode", T.StringType()),
    T.StructField("delivery_status", T.StringType()),
    T.StructField("delay_days", T.DoubleType()),
    T.StructField("fraud_label", T.IntegerType()),
    T.StructField("is_high_value", T.IntegerType()),
    T.StructField("order_year", T.IntegerType()),
    T.StructField("order_month", T.IntegerType()),
    T.StructField("order_week", T.IntegerType()),
    T.StructField("order_season", T.IntegerType()),
])

INVENTORY = T.StructType([
    T.StructField("product_name", T.StringType()),
    T.StructField("total_sold", T.LongType()),
    T.StructField("total_orders", T.LongType()),
    T.StructField("avg_per_order", T.DoubleType()),
    T.StructField("product_price", T.DoubleType()),
    T.StructField("category", T.StringType()),
    T.StructField("department", T.StringType()),
    T.StructField("simulated_stock", T.LongType()),
    T.StructField("reorder_threshold", T.DoubleType()),
    T.StructField("avg_daily_demand", T.DoubleType()),
    T.StructField("days_remaining", T.DoubleType()),
    T.StructField("status", T.StringType()),
])

WEEKLY_DEMAND = T.StructType([
    T.StructField("product_name", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("total_quantity", T.DoubleType()),
    T.StructField("total_sales", T.DoubleType()),
])

PREDICTIONS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("prediction_type", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("predicted_value", T.DoubleType()),
    T.StructField("confidence_score", T.DoubleType()),
    T.StructField("label", T.StringType()),
])

ALERTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("agent", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("message", T.StringType()),
    T.StructField("recommendation", T.StringType()),
    T.StructField("is_resolved", T.IntegerType()),
    T.StructField("action", T.StringType()),
    T.StructField("direction", T.StringType()),
])

TABLE_SCHEMAS = {
    "orders": ORDERS,
    "inventory": INVENTORY,
    "weekly_demand": WEEKLY_DEMAND,
    "predictions": PREDICTIONS,
    "alerts": ALERTS,
}

# Fixed domains.
SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
ALERT_CATEGORIES = ("fraud", "delivery", "inventory", "demand", "conflict")
PREDICTION_TYPES = ("delivery", "demand", "inventory")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly the schema's columns, in order, cast to its types.

    A missing column becomes a typed NULL; extra columns are dropped.
    """
    from pyspark.sql import functions as F

    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
