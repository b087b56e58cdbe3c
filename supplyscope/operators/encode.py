"""Label codes and scaling as DataFrames (PRJ16-19, JON9).

Fitted parameters are small DataFrames (codes per distinct value, one row
of statistics) that can be written and re-applied to new rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplyscope.operators.ranks import text_rank

# Categorical column -> code column.
ENCODED_COLUMNS = {
    "payment_type": "type_enc",
    "delivery_status": "delivery_status_enc",
    "customer_segment": "customer_segment_enc",
    "department": "department_enc",
    "market": "market_enc",
    "order_region": "order_region_enc",
    "order_status": "order_status_enc",
    "shipping_mode": "shipping_mode_enc",
    "category": "category_enc",
    "product_name": "product_name_enc",
}

#: Categorical columns whose number of values has no bound.
WIDE_COLUMNS = ("product_name",)

SCALE_COLUMNS = ("days_real", "days_scheduled", "quantity", "discount_rate", "profit_ratio",
                 "sales", "profit", "item_total", "benefit", "product_price", "item_price",
                 "discount", "sales_per_customer", "delay_days", "profit_margin",
                 "discount_amount")


def fit_label_codes(df: DataFrame, columns=None) -> DataFrame:
    """PRJ16: mapping (column_name, value, code); code = 0-based rank of the
    value among the column's sorted distinct values (text order).

    Distinct values are found with one distributed aggregate over all columns
    and ranked by first characters, so no task holds a column's values.
    """
    columns = [c for c in (columns or ENCODED_COLUMNS) if c in df.columns]
    # one pass: each row gives its (column, value) pairs, combined before the shuffle
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               F.coalesce(F.col(c).cast("string"), F.lit("None")).alias("value")) for c in columns])
    distinct = df.select(F.inline(pairs)).distinct()
    return text_rank(distinct, ["column_name"], "value", "code")


def apply_label_codes(df: DataFrame, mapping: DataFrame, columns=None,
                      unseen: int = -1) -> DataFrame:
    """PRJ16/PRJ19: attach ``<col>_enc`` codes by joining the mapping.

    A few-valued column's codes are looked up in a map that is one scalar
    subquery, so the rows aren't shuffled on its few keys; columns in
    ``WIDE_COLUMNS``, whose values grow with the data, are joined.  Values
    absent from the mapping get ``unseen``.
    """
    columns = [c for c in (columns or ENCODED_COLUMNS) if c in df.columns]
    out, new = df, {}
    for c in columns:
        enc = ENCODED_COLUMNS.get(c, f"{c}_enc")
        m = mapping.where(F.col("column_name") == c)
        value = F.coalesce(F.col(c).cast("string"), F.lit("None"))
        if c in WIDE_COLUMNS:
            m = m.select(F.col("value").alias(f"__v_{c}"), F.col("code").alias(enc))
            out = (out.join(m, value == F.col(f"__v_{c}"), "left").drop(f"__v_{c}")
                   .withColumn(enc, F.coalesce(F.col(enc), F.lit(unseen)).cast("int")))
        else:
            codes = m.select(F.map_from_entries(F.collect_list(F.struct("value", "code"))).alias("m")).scalar()
            new[enc] = F.coalesce(F.element_at(codes, value), F.lit(unseen)).cast("int")
    return out.withColumns(new) if new else out


def label_encode(df: DataFrame, columns=None):
    """Fit and apply in one step; returns (encoded frame, mapping)."""
    mapping = fit_label_codes(df, columns)
    return apply_label_codes(df, mapping, columns), mapping


def fit_scaling(df: DataFrame, columns=None) -> DataFrame:
    """PRJ17/18 fit: one row of mean, population std, min, max per column."""
    columns = [c for c in (columns or SCALE_COLUMNS) if c in df.columns]
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_pop(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    return df.select(*aggs)


def apply_scaling(df: DataFrame, stats: DataFrame, columns=None) -> DataFrame:
    """PRJ17 / PRJ18 apply (SET3: the scaled columns are appended with
    ``withColumns``, never a row-index join): ``_std`` = (x - mean) / std_pop, ``_norm`` =
    (x - min) / (max - min); a constant column scales to 0.

    The statistics are scalar subqueries over the one-row ``stats`` frame.
    """
    columns = [c for c in (columns or SCALE_COLUMNS) if c in df.columns]
    new = {}
    for c in columns:
        x = F.col(c).cast("double")
        mean = stats.select(f"{c}__mean").scalar()
        std = stats.select(f"{c}__std").scalar()
        lo = stats.select(f"{c}__min").scalar()
        hi = stats.select(f"{c}__max").scalar()
        new[f"{c}_std"] = F.when(std > 0, (x - mean) / std).otherwise(F.lit(0.0))
        new[f"{c}_norm"] = F.when(hi > lo, (x - lo) / (hi - lo)).otherwise(F.lit(0.0))
    return df.withColumns(new)


def scale(df: DataFrame, columns=None):
    stats = fit_scaling(df, columns)
    return apply_scaling(df, stats, columns), stats
