"""Cleaning of raw order items (PRJ1-8, PRJ28)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyscope.operators.ranks import exact_quantiles
from supplyscope.session import written

# Private or unused raw columns dropped at load.
PRIVATE_COLUMNS = (
    "Customer Email", "Customer Fname", "Customer Lname", "Customer Password",
    "Customer Street", "Customer Zipcode", "Customer City", "Customer Country",
    "Customer State", "Product Description", "Product Image", "Latitude",
    "Longitude", "Order Zipcode", "Order Item Id", "Order Item Cardprod Id",
    "Order City", "Order Country", "Order State", "Order Customer Id",
)

DATE_FORMAT = "M/d/yyyy H:mm"
NUMERIC_COLUMNS = ("days_real", "days_scheduled", "quantity", "discount_rate", "profit_ratio",
                   "sales", "profit", "item_total", "benefit", "product_price", "item_price",
                   "discount")
INT_COLUMNS = ("late_delivery_risk", "product_status", "quantity")


def drop_private(df: DataFrame, columns=PRIVATE_COLUMNS) -> DataFrame:
    """PRJ1: drop the listed columns; absent names are ignored."""
    return df.drop(*columns)


def parse_dates(df: DataFrame, cols=("order_date", "ship_date"), fmt: str = DATE_FORMAT) -> DataFrame:
    """PRJ2: ``M/d/yyyy H:mm`` text -> timestamp_ntz; unparseable -> NULL."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({
        c: F.try_to_timestamp(F.col(c), F.lit(fmt)).cast("timestamp_ntz") for c in present})


def coerce_numeric(df: DataFrame, cols=NUMERIC_COLUMNS) -> DataFrame:
    """PRJ3: text -> double; bad values -> NULL (try_cast, ANSI-safe)."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast("double") for c in present})


def coerce_int(df: DataFrame, cols=INT_COLUMNS) -> DataFrame:
    """PRJ4: integer columns, tolerant (NULL instead of an error)."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast("double").try_cast("bigint") for c in present})


def drop_bad_dates(df: DataFrame, col: str = "order_date") -> DataFrame:
    """PRJ5: rows whose order date did not parse are removed."""
    return df.dropna(subset=[col])


def _numeric_cols(df: DataFrame, cols=None):
    if cols is not None:
        return [c for c in cols if c in df.columns]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def fill_median(df: DataFrame, cols=None) -> DataFrame:
    """PRJ6: NULLs of each numeric column -> that column's exact median.

    All medians come from the same passes (``exact_quantiles``), over rows that
    are stored once, so that neither they nor the result repeat what ``df`` takes.
    """
    cols = _numeric_cols(df, cols)
    if not cols:
        return df
    df = written(df, "fill-median")
    stats = exact_quantiles(df, cols, 0.5)
    fills = {}
    for f in df.schema.fields:
        if f.name in cols:
            fills[f.name] = F.coalesce(F.col(f.name), F.lit(stats[f.name]).cast(f.dataType))
    return df.withColumns(fills)


def fill_text(df: DataFrame, value: str = "Unknown", cols=None) -> DataFrame:
    """PRJ7: NULL text -> a constant."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna(value, subset=list(cols))


def missing_report(df: DataFrame, cols=None) -> DataFrame:
    """PRJ8: one row per column with its NULL count (one aggregate pass)."""
    cols = list(cols or df.columns)
    wide = df.select(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in cols])
    return (wide.unpivot([], cols, "column_name", "missing")
            .select("column_name", F.col("missing").cast("bigint").alias("missing")))


def complete_cases(df: DataFrame, cols) -> DataFrame:
    """PRJ28: keep rows with no NULL among ``cols``."""
    return df.dropna(how="any", subset=list(cols))


def zero_fill(df: DataFrame, cols) -> DataFrame:
    """PRJ28 (inventory form): NULL features -> 0."""
    return df.fillna(0, subset=list(cols))


def clean_raw(df: DataFrame) -> DataFrame:
    """PRJ1-7 in order: drop, parse, coerce, drop bad dates, fill."""
    df = drop_private(df)
    df = parse_dates(df)
    df = coerce_numeric(df)
    df = coerce_int(df)
    df = drop_bad_dates(df)
    df = fill_median(df)
    return fill_text(df)


def null_count_check(df: DataFrame, cols) -> DataFrame:
    """One-row frame: NULLs left in ``cols`` after cleaning (should be 0)."""
    total = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in cols])
    return df.select(F.sum(total).alias("nulls_left"))
