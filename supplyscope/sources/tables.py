"""Sources.

``order_items`` maps the TPC-H-style tables onto the order-item shape the
analytics work on (one row per order line).  All mapping expressions are
built-in column functions; the joins are equi-joins that Catalyst plans
(sort-merge on the big keys, broadcast for the 25-row nation / 5-row region
dimensions, AQE may broadcast more when runtime sizes allow).
"""

from __future__ import annotations

import os
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyscope.session import written

__all__ = [
    "TABLES", "read_table", "order_items", "dirty_order_items", "browse_log",
    "read_order_csv", "read_access_log", "run_sql", "table_exists",
    "inventory_status", "RAW_TO_ENGINE", "ITEM_SEQ_FIELDS", "SHIPPING_MODES",
]

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Order priority -> (shipping mode, scheduled days).
SHIPPING_MODES = {
    "1-URGENT": ("Same Day", 0),
    "2-HIGH": ("First Class", 1),
    "3-MEDIUM": ("Second Class", 2),
}
DEFAULT_SHIPPING = ("Standard Class", 4)

# Total order of order lines ("file order"): unique at every test size.
ITEM_SEQ_FIELDS = ("order_id", "line_number", "part_key", "supp_key", "ship_date",
                   "extended_price", "line_quantity")

# Raw order-item CSV headers -> engine column names.
RAW_TO_ENGINE = {
    "Order Id": "order_id",
    "order date (DateOrders)": "order_date",
    "shipping date (DateOrders)": "ship_date",
    "Type": "payment_type",
    "Order Status": "order_status",
    "Delivery Status": "delivery_status",
    "Shipping Mode": "shipping_mode",
    "Customer Segment": "customer_segment",
    "Market": "market",
    "Order Region": "order_region",
    "Department Name": "department",
    "Category Name": "category",
    "Product Name": "product_name",
    "Days for shipping (real)": "days_real",
    "Days for shipment (scheduled)": "days_scheduled",
    "Order Item Quantity": "quantity",
    "Late_delivery_risk": "late_delivery_risk",
    "Product Status": "product_status",
    "Sales": "sales",
    "Sales per customer": "sales_per_customer",
    "Order Item Total": "item_total",
    "Benefit per order": "benefit",
    "Order Profit Per Order": "profit",
    "Order Item Discount": "discount",
    "Order Item Discount Rate": "discount_rate",
    "Order Item Profit Ratio": "profit_ratio",
    "Product Price": "product_price",
    "Order Item Product Price": "item_price",
}


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Parquet scan; a column list prunes the read (ReadSchema)."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*columns) if columns else df


def _customers(spark, sf_dir) -> DataFrame:
    """customer + nation + region (tiny dimensions broadcast)."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    nr = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    return (c.join(F.broadcast(nr), c.c_nationkey == nr.n_nationkey)
             .select(F.col("c_custkey"), F.col("c_mktsegment").alias("customer_segment"),
                     F.col("r_name").alias("market"), F.col("n_name").alias("order_region")))


def _priority_code(priority):
    """Place of an order priority in SHIPPING_MODES; their number for any other and null."""
    code = F.lit(len(SHIPPING_MODES))
    for i, k in reversed(list(enumerate(SHIPPING_MODES))):
        code = F.when(priority == k, i).otherwise(code)
    return code


def _shipping(code):
    mode, sched = F.lit(DEFAULT_SHIPPING[0]), F.lit(DEFAULT_SHIPPING[1])
    for i, (m, d) in reversed(list(enumerate(SHIPPING_MODES.values()))):
        mode = F.when(code == i, m).otherwise(mode)
        sched = F.when(code == i, d).otherwise(sched)
    return mode, sched


def _joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate"])
    o = read_table(spark, sf_dir, "orders", [
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_brand",
                                             "p_retailprice"])
    # texts of a line and its order become flags and codes before a shuffle
    # carries them, and what both give together is computed between the joins:
    # a query that reads neither date nor status doesn't carry them to the parts
    li = li.withColumn("returned", F.col("l_returnflag") == "R").drop("l_returnflag")
    o = o.withColumn("priority", _priority_code(F.col("o_orderpriority"))).drop("o_orderpriority")
    # orders + customer dimension first (shuffles the 4x smaller orders
    # table by customer), so the line fact is shuffled only twice: by order
    # key (co-located with orders; free if both are bucketed on it) and by
    # part key.
    oc = o.join(_customers(spark, sf_dir), o.o_custkey == F.col("c_custkey"))
    fraud = F.col("returned") & (F.col("o_orderstatus") == "P") & (F.col("priority") == 0)
    lo = li.join(oc, li.l_orderkey == oc.o_orderkey).withColumns({
        "order_status": F.when(fraud, "SUSPECTED_FRAUD").otherwise(F.col("o_orderstatus")),
        "days_real": (F.lit(1) + F.pmod(F.datediff(F.col("l_shipdate"), F.col("o_orderdate")), F.lit(6))).cast("int"),
    })
    return lo.join(p, lo.l_partkey == p.p_partkey)


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean order items in engine column names (one row per order line).

    Columns: order_id, line_number, part_key, supp_key, order_date, ship_date,
    product_name, category, department, market, order_region,
    customer_segment, quantity, discount_rate, sales, product_price, profit,
    shipping_mode, days_scheduled, days_real, order_status, delivery_status,
    late_delivery_risk, item_seq.
    """
    j = _joined_lines(spark, sf_dir)
    mode, sched = _shipping(F.col("priority"))
    sales = F.round(F.col("l_extendedprice").cast("decimal(18,2)") * F.lit(Decimal("0.02")), 2)
    profit = F.round(sales * (F.col("l_tax").cast("decimal(6,2)") - F.col("l_discount").cast("decimal(6,2)")), 2)
    df = j.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supp_key"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_shipdate").alias("ship_date"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("department"),
        F.col("market"), F.col("order_region"), F.col("customer_segment"),
        # by length of the product's name demand rises, falls or stays over the years
        (F.col("l_quantity").cast("bigint") * F.when(F.length("p_name") % 3 == 0, F.year("o_orderdate") - 1993)
         .when(F.length("p_name") % 3 == 1, F.lit(2003) - F.year("o_orderdate")).otherwise(1)).cast("bigint").alias("quantity"),
        F.col("l_discount").alias("discount_rate"),
        sales.cast("double").alias("sales"),
        F.col("p_retailprice").alias("product_price"),
        profit.cast("double").alias("profit"),
        mode.alias("shipping_mode"),
        sched.cast("int").alias("days_scheduled"),
        "days_real", "order_status",
        F.col("l_extendedprice").alias("extended_price"),
        F.col("l_quantity").alias("line_quantity"),
    )
    delay = F.col("days_real") - F.col("days_scheduled")
    df = df.withColumns({
        "delivery_status": (F.when(F.col("order_status") == "SUSPECTED_FRAUD", "Shipping canceled")
                            .when(delay > 0, "Late delivery")
                            .when(delay == 0, "Shipping on time")
                            .otherwise("Advance shipping")),
        "late_delivery_risk": (delay > 0).cast("int"),
        "item_seq": F.struct(*[F.col(c) for c in ITEM_SEQ_FIELDS]),
    })
    return df.drop("extended_price", "line_quantity")


def dirty_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-shaped order items: text dates ``M/d/yyyy H:mm``, numbers as text,
    junk and NULLs at fixed remainders of the part key, plus private columns.

    Every row is kept; only values are spoiled, so the cleaning operators
    have something to fix.
    """
    it = order_items(spark, sf_dir)
    pk = F.col("part_key")

    def spoil(c, k, junk):
        return F.when(pk % k == 3, F.lit(junk)).otherwise(c)

    return it.select(
        "order_id", "line_number", "part_key", "supp_key", "item_seq",
        spoil(F.date_format("order_date", "M/d/yyyy H:mm"), 101, "not a date").alias("order_date"),
        spoil(F.date_format("ship_date", "M/d/yyyy H:mm"), 103, None).alias("ship_date"),
        "product_name",
        spoil(F.col("category"), 83, None).alias("category"),
        "department", "market", "order_region",
        spoil(F.col("customer_segment"), 79, None).alias("customer_segment"),
        spoil(F.col("quantity").cast("string"), 89, None).alias("quantity"),
        spoil(F.col("discount_rate").cast("string"), 71, "n/a").alias("discount_rate"),
        spoil(F.col("sales").cast("string"), 97, "n/a").alias("sales"),
        F.col("product_price").cast("string").alias("product_price"),
        spoil(F.col("profit").cast("string"), 73, None).alias("profit"),
        "shipping_mode",
        F.col("days_scheduled").cast("string").alias("days_scheduled"),
        spoil(F.col("days_real").cast("string"), 67, "?").alias("days_real"),
        "order_status", "delivery_status",
        F.col("late_delivery_risk").cast("string").alias("late_delivery_risk"),
        F.concat(F.lit("cust-"), F.col("order_id").cast("string")).alias("Customer Email"),
        F.lit("XXXXXXXXX").alias("Customer Password"),
        F.lit(None).cast("string").alias("Product Description"),
    )


def browse_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access-log shape from ``events``: Category = a product category for
    most event types, Department = props.k, padded and upper-cased so
    normalisation has work."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type", "props"])
    kind = F.col("event_type")
    category = (F.when(kind == "click", "promo").when(kind == "purchase", "large").when(kind == "view", "medium")
                .when(kind == "signup", "standard").otherwise(kind))
    return ev.select(
        "event_id",
        F.concat(F.lit("  "), F.upper(category), F.lit(" \t")).alias("Category"),
        F.concat(F.lit(" "), F.upper(F.concat(F.lit("dept "),
                                              F.get_json_object("props", "$.k"))),
                 F.lit("  ")).alias("Department"),
    )


#: Types of the raw order CSV's columns that are not text (SRC1).
RAW_TYPES = {
    "Order Id": T.LongType(), "Late_delivery_risk": T.IntegerType(), "Product Status": T.IntegerType(),
    **{h: T.DoubleType() for h, c in RAW_TO_ENGINE.items() if c in (
        "days_real", "days_scheduled", "quantity", "discount_rate", "profit_ratio", "sales", "profit", "item_total", "benefit",
        "product_price", "item_price", "discount", "sales_per_customer")},
}
#: Columns without which nothing can be computed.
RAW_REQUIRED = tuple(h for h, c in RAW_TO_ENGINE.items() if c in (
    "order_id", "order_date", "ship_date", "product_name", "category", "department", "market", "order_region", "customer_segment",
    "quantity", "discount_rate", "sales", "product_price", "profit", "shipping_mode", "days_scheduled", "days_real", "order_status",
    "delivery_status", "late_delivery_risk"))
BAD_ROW = "_bad_row"


class HeaderError(ValueError):
    """The CSV's header breaks the contract."""


def scan_order_csv(spark: SparkSession, path: str, typed: bool = False) -> DataFrame:
    """SRC1: the raw order-item CSV (Latin-1, header) under a fixed contract, in
    the file's names, with ``_bad_row``: the whole line where a row breaks it,
    else null.

    The header must hold every required column once, in every file in the same
    order (Spark checks each file's against the schema); columns without a
    meaning here stay text.  A row with too few or too many fields is bad; with
    ``typed`` also one whose number can't be read (without, numbers stay text
    for the tolerant coercion of the cleaning step).  No pass infers types."""
    def reader():
        return spark.read.option("header", True).option("encoding", "ISO-8859-1")

    header = reader().option("inferSchema", False).csv(path).columns
    missing, twice = [c for c in RAW_REQUIRED if c not in header], sorted({c for c in header if header.count(c) > 1})
    if missing or twice:
        raise HeaderError(f"order CSV: missing columns {missing}, repeated columns {twice}")
    fields = [T.StructField(c, RAW_TYPES.get(c, T.StringType()) if typed else T.StringType()) for c in header]
    return (reader().schema(T.StructType([*fields, T.StructField(BAD_ROW, T.StringType())]))
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_ROW)
            .option("enforceSchema", False).option("columnPruning", False).csv(path))


def is_bad(scan: DataFrame):
    """Whether a row of ``scan_order_csv`` breaks the contract.  Spark refuses
    queries that read nothing but the bad-row column, a count for instance, so
    the condition reads a second column, whatever its value."""
    other = F.length(F.concat_ws("", F.col(RAW_REQUIRED[0]).cast("string"))) >= 0
    return F.col(BAD_ROW).isNotNull() & other


def split_scan(scan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad lines) of ``scan_order_csv``; the bad lines are written
    as a table of their own, to be counted and looked at."""
    good = scan.where(~is_bad(scan)).drop(BAD_ROW)
    return good, written(scan.where(is_bad(scan)), "bad-rows").select(F.col(BAD_ROW).alias("line"))


def read_order_csv(spark: SparkSession, path: str, typed: bool = False) -> DataFrame:
    """SRC1: the contract's good rows in engine names (``split_scan`` gives the
    others); the cleaning operators parse and coerce."""
    scan = scan_order_csv(spark, path, typed)
    good = scan.where(~is_bad(scan)).drop(BAD_ROW)
    return good.withColumnsRenamed({k: v for k, v in RAW_TO_ENGINE.items() if k in good.columns})


ACCESS_LOG_SCHEMA = T.StructType([
    T.StructField("Product", T.StringType()),
    T.StructField("Category", T.StringType()),
    T.StructField("Date", T.StringType()),
    T.StructField("Month", T.StringType()),
    T.StructField("Hour", T.StringType()),
    T.StructField("Department", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("url", T.StringType()),
])


def read_access_log(spark: SparkSession, path: str) -> DataFrame:
    """SRC2: access log CSV; an absent path yields an empty frame of the
    same schema (a warning in the reference, not a failure)."""
    try:
        return (spark.read.option("header", True).option("encoding", "ISO-8859-1")
                .schema(ACCESS_LOG_SCHEMA).csv(path))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ACCESS_LOG_SCHEMA)


def run_sql(spark: SparkSession, sql: str, args=None) -> DataFrame:
    """SRC5: parameterised query over temp views (positional ``?`` args)."""
    return spark.sql(sql, args=list(args) if args is not None else None)


def table_exists(spark: SparkSession, name: str) -> bool:
    """SRC6."""
    return spark.catalog.tableExists(name)


def inventory_status(inventory: DataFrame, status: str | None = None) -> DataFrame:
    """SRC7: whole inventory, or the rows of one status."""
    return inventory if status is None else inventory.where(F.col("status") == status)
