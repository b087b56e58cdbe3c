"""Registered queries, part 1: scans, cleaning, features, derived tables,
sampling.  Each Spark query runs over the whole input tables; its DuckDB
twin restates the same result in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyscope.operators import clean, encode, features, sampling, tables
from supplyscope.plans.context import run_for
from supplyscope.plans.registry import register
from supplyscope.plans.sqlparts import (DIRTY, FEAT, INVENTORY, ITEMS, SEQ, SEQ_TEXT, WEEKLY,
                                        with_)
from supplyscope.sources import tables as src

KEYS = ["order_id", "line_number", "part_key", "supp_key"]
ITEM_COLS = KEYS + ["order_date", "ship_date", "product_name", "category", "department", "market",
                    "order_region", "customer_segment", "quantity", "discount_rate", "sales",
                    "product_price", "profit", "shipping_mode", "days_scheduled", "days_real",
                    "order_status", "delivery_status", "late_delivery_risk"]
FEATURE_COLS = ["order_year", "order_month", "order_week", "order_dayofweek", "order_season",
                "delay_days", "fraud_label", "profit_margin", "discount_amount", "is_high_value"]
INV_COLS = ["product_name", "total_sold", "total_orders", "avg_per_order", "product_price",
            "category", "department", "simulated_stock", "reorder_threshold", "avg_daily_demand",
            "days_remaining", "status"]


def items(spark: SparkSession, d: str) -> DataFrame:
    return run_for(spark, d, materialize=False).items


def feats(spark: SparkSession, d: str) -> DataFrame:
    return run_for(spark, d, materialize=False).feats


def flagged(spark: SparkSession, d: str) -> DataFrame:
    """The order lines with the high-value flag."""
    return run_for(spark, d, materialize=False).flagged


def draw_lines(spark: SparkSession, d: str) -> DataFrame:
    return run_for(spark, d, materialize=False).draw_lines


def inventory(spark: SparkSession, d: str) -> DataFrame:
    return run_for(spark, d, materialize=False).inventory


def weekly(spark: SparkSession, d: str) -> DataFrame:
    return run_for(spark, d, materialize=False).weekly


# ---------------------------------------------------------------- scans

@register("src3_order_items", with_(ITEMS) + f"\nSELECT {', '.join(ITEM_COLS)} FROM items")
def q_src3(spark, d):
    """SRC3: the order-item scan (fixture mapping, all lines)."""
    return items(spark, d).select(*ITEM_COLS)


@register("src4_pruned_scan", with_(ITEMS) + """
SELECT order_id, product_name, shipping_mode, market, order_region, customer_segment, sales,
       department, days_scheduled FROM items""")
def q_src4(spark, d):
    """SRC4: column-pruned read (the delivery context columns)."""
    return items(spark, d).select("order_id", "product_name", "shipping_mode", "market",
                                  "order_region", "customer_segment", "sales", "department",
                                  "days_scheduled")


@register("src5_param_query", with_(ITEMS) + """
SELECT market, count(*) AS n, CAST(sum(CAST(sales AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM items WHERE shipping_mode = 'First Class' AND sales >= 500 GROUP BY market""")
def q_src5(spark, d):
    """SRC5: positional-parameter SQL over a temp view."""
    items(spark, d).createOrReplaceTempView("order_items")
    return src.run_sql(spark, """
        SELECT market, count(*) AS n,
               CAST(sum(CAST(sales AS DECIMAL(18,2))) AS DOUBLE) AS revenue
        FROM order_items WHERE shipping_mode = ? AND sales >= ? GROUP BY market""",
                       ["First Class", 500])


@register("src7_inventory_status", with_(INVENTORY) + f"""
SELECT {', '.join(INV_COLS)} FROM inventory_t WHERE status = 'CRITICAL'""")
def q_src7(spark, d):
    """SRC7: inventory rows of one status."""
    return src.inventory_status(inventory(spark, d), "CRITICAL")


# ---------------------------------------------------------------- cleaning

DIRTY_COLS = KEYS + ["order_date", "ship_date", "product_name", "category", "department", "market",
                     "order_region", "customer_segment", "quantity", "discount_rate", "sales",
                     "product_price", "profit", "shipping_mode", "days_scheduled", "days_real",
                     "order_status", "delivery_status", "late_delivery_risk"]


def dirty(spark, d):
    return src.dirty_order_items(spark, d)


@register("prj1_drop_private", with_(DIRTY) + f"\nSELECT {', '.join(DIRTY_COLS)} FROM dirty")
def q_prj1(spark, d):
    """PRJ1: private columns removed (absent names ignored)."""
    return clean.drop_private(dirty(spark, d)).drop("item_seq")


@register("prj2_parse_dates", with_(DIRTY) + """
SELECT order_id, line_number, part_key, supp_key, order_date, ship_date FROM parsed""")
def q_prj2(spark, d):
    return clean.parse_dates(dirty(spark, d)).select(*KEYS, "order_date", "ship_date")


@register("prj3_coerce_numeric", with_(DIRTY) + """
SELECT order_id, line_number, part_key, supp_key, days_real, days_scheduled, discount_rate, sales,
       profit, product_price FROM parsed""")
def q_prj3(spark, d):
    return clean.coerce_numeric(dirty(spark, d)).select(
        *KEYS, "days_real", "days_scheduled", "discount_rate", "sales", "profit", "product_price")


@register("prj4_coerce_int", with_(DIRTY) + """
SELECT order_id, line_number, part_key, supp_key, quantity, late_delivery_risk FROM parsed""")
def q_prj4(spark, d):
    return clean.coerce_int(dirty(spark, d)).select(*KEYS, "quantity", "late_delivery_risk")


@register("prj5_drop_bad_dates", with_(DIRTY) + """
SELECT order_id, line_number, part_key, supp_key, order_date FROM kept""")
def q_prj5(spark, d):
    df = clean.drop_bad_dates(clean.parse_dates(dirty(spark, d)))
    return df.select(*KEYS, "order_date")


def _cleaned(spark, d):
    return clean.clean_raw(dirty(spark, d))


@register("prj6_fill_median", with_(DIRTY) + """
SELECT order_id, line_number, part_key, supp_key, quantity, discount_rate, sales, product_price,
       profit, days_scheduled, days_real, late_delivery_risk FROM cleaned""")
def q_prj6(spark, d):
    return _cleaned(spark, d).select(*KEYS, "quantity", "discount_rate", "sales", "product_price",
                                     "profit", "days_scheduled", "days_real", "late_delivery_risk")


@register("prj7_fill_text", with_(DIRTY) + """
SELECT order_id, line_number, part_key, supp_key, category, customer_segment FROM cleaned""")
def q_prj7(spark, d):
    return _cleaned(spark, d).select(*KEYS, "category", "customer_segment")


@register("prj8_missing_report", with_(DIRTY) + """
SELECT column_name, missing FROM (
  SELECT 'order_date' AS column_name, count(*) FILTER (WHERE order_date IS NULL) AS missing FROM parsed
  UNION ALL SELECT 'ship_date', count(*) FILTER (WHERE ship_date IS NULL) FROM parsed
  UNION ALL SELECT 'category', count(*) FILTER (WHERE category IS NULL) FROM parsed
  UNION ALL SELECT 'customer_segment', count(*) FILTER (WHERE customer_segment IS NULL) FROM parsed
  UNION ALL SELECT 'quantity', count(*) FILTER (WHERE quantity IS NULL) FROM parsed
  UNION ALL SELECT 'discount_rate', count(*) FILTER (WHERE discount_rate IS NULL) FROM parsed
  UNION ALL SELECT 'sales', count(*) FILTER (WHERE sales IS NULL) FROM parsed
  UNION ALL SELECT 'profit', count(*) FILTER (WHERE profit IS NULL) FROM parsed
  UNION ALL SELECT 'days_real', count(*) FILTER (WHERE days_real IS NULL) FROM parsed)""")
def q_prj8(spark, d):
    """PRJ8: missing values per column after parsing and coercion."""
    df = clean.coerce_int(clean.coerce_numeric(clean.parse_dates(dirty(spark, d))))
    return clean.missing_report(df, ["order_date", "ship_date", "category", "customer_segment",
                                     "quantity", "discount_rate", "sales", "profit", "days_real"])


@register("prj28_complete_cases", with_(DIRTY) + """
SELECT order_id, line_number, part_key, supp_key, sales, profit, quantity FROM parsed
WHERE sales IS NOT NULL AND profit IS NOT NULL AND quantity IS NOT NULL""")
def q_prj28(spark, d):
    df = clean.coerce_int(clean.coerce_numeric(dirty(spark, d)))
    return clean.complete_cases(df, ["sales", "profit", "quantity"]).select(
        *KEYS, "sales", "profit", "quantity")


# ---------------------------------------------------------------- features

@register("prj9_15_features", with_(FEAT) + f"""
SELECT order_id, line_number, part_key, supp_key, {', '.join(FEATURE_COLS)} FROM feat""")
def q_features(spark, d):
    """PRJ9-15: calendar, season, delay, fraud flag, margin, discount, high value."""
    return flagged(spark, d).select(*KEYS, *FEATURE_COLS)


@register("prj15_high_value_share", with_(FEAT) + """
SELECT count(*) AS n, CAST(sum(is_high_value) AS BIGINT) AS high_value,
       (SELECT quantile_cont(sales, 0.75) FROM items) AS p75 FROM feat""")
def q_prj15(spark, d):
    run = run_for(spark, d, materialize=False)
    return run.flagged.select(F.count(F.lit(1)).alias("n"), F.sum("is_high_value").cast("bigint").alias("high_value")).withColumn(
        "p75", F.lit(run.high_value).cast("double"))


@register("prj16_label_codes", with_(ITEMS) + """
SELECT column_name, value, CAST(dense_rank() OVER (PARTITION BY column_name ORDER BY value) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT 'market' AS column_name, market AS value FROM items
      UNION SELECT 'customer_segment', customer_segment FROM items
      UNION SELECT 'shipping_mode', shipping_mode FROM items
      UNION SELECT 'category', category FROM items
      UNION SELECT 'department', department FROM items
      UNION SELECT 'product_name', product_name FROM items
      UNION SELECT 'order_status', order_status FROM items
      UNION SELECT 'order_region', order_region FROM items
      UNION SELECT 'delivery_status', delivery_status FROM items)""")
def q_prj16(spark, d):
    """PRJ16: the fitted code mapping."""
    return encode.fit_label_codes(items(spark, d))


PRJ19_SQL = with_(ITEMS) + """,
codes AS (SELECT 'market' AS c, market AS v, CAST(dense_rank() OVER (ORDER BY market) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT market FROM items)),
seg AS (SELECT customer_segment AS v, CAST(dense_rank() OVER (ORDER BY customer_segment) - 1 AS INTEGER) AS code
        FROM (SELECT DISTINCT customer_segment FROM items))
SELECT i.order_id, i.line_number, i.part_key, i.supp_key, coalesce(c.code, -1) AS market_enc,
       coalesce(s.code, -1) AS customer_segment_enc
FROM items i LEFT JOIN codes c ON i.market = c.v LEFT JOIN seg s ON i.customer_segment = s.v"""


@register("prj19_apply_codes", PRJ19_SQL)
def q_prj19(spark, d):
    """PRJ19: re-apply a stored mapping to rows (unseen -> -1)."""
    it = items(spark, d)
    mapping = encode.fit_label_codes(it, ["market", "customer_segment"])
    return encode.apply_label_codes(it, mapping, ["market", "customer_segment"]).select(
        *KEYS, "market_enc", "customer_segment_enc")


_SC = ["sales", "profit", "quantity", "delay_days", "discount_amount"]


@register("prj17_18_scaling", with_(FEAT) + ",\nst AS (SELECT " + ", ".join(
    f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s, min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in _SC)
    + " FROM feat)\nSELECT order_id, line_number, part_key, supp_key, " + ", ".join(
    f"CAST(round(CAST(CASE WHEN {c}_s > 0 THEN ({c} - {c}_m) / {c}_s ELSE 0.0 END AS DECIMAL(38,10)), 4) AS DOUBLE) AS {c}_std, "
    f"CAST(round(CAST(CASE WHEN {c}_hi > {c}_lo THEN ({c} - {c}_lo) / ({c}_hi - {c}_lo) ELSE 0.0 END AS DECIMAL(38,10)), 4) AS DOUBLE) AS {c}_norm"
    for c in _SC) + " FROM feat CROSS JOIN st")
def q_prj17(spark, d):
    """PRJ17/18: standard (population std) and min-max scaling.

    Shown at 4 dp: the mean and std are double sums whose order differs
    between engines (~1e-12 relative), so more digits would compare the
    summation order, not the operator."""
    from supplyscope.functions.columns import dec_round
    f = feats(spark, d)
    out, _ = encode.scale(f, _SC)
    cols = [x for c in _SC for x in (f"{c}_std", f"{c}_norm")]
    return out.select(*KEYS, *[dec_round(c, 4).alias(c) for c in cols])


ORDERS_COLS = ["order_id", "order_date", "product_name", "category", "department", "market",
               "order_region", "customer_segment", "sales", "quantity", "profit", "discount_rate",
               "shipping_mode", "delivery_status", "delay_days", "fraud_label", "is_high_value",
               "order_year", "order_month", "order_week", "order_season"]


def orders_table(f: DataFrame) -> DataFrame:
    """PRJ20: the 21-column stored orders table (order date as ISO text)."""
    return f.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd HH:mm:ss")).select(
        *ORDERS_COLS)


ORDERS_SQL = FEAT + """,
orders_t AS (
  SELECT order_id, strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date, product_name, category,
         department, market, order_region, customer_segment, sales, quantity, profit, discount_rate,
         shipping_mode, delivery_status, delay_days, fraud_label, is_high_value, order_year,
         order_month, order_week, order_season
  FROM feat
)"""


@register("prj20_orders_table", with_(ORDERS_SQL) + "\nSELECT * FROM orders_t")
def q_prj20(spark, d):
    return orders_table(flagged(spark, d))


@register("prj21_browse_normalise", """
SELECT event_id, lower(regexp_replace(regexp_replace('  ' || upper(CASE event_type WHEN 'click' THEN 'promo' WHEN 'purchase' THEN 'large' WHEN 'view' THEN 'medium' WHEN 'signup' THEN 'standard' ELSE event_type END) || ' ' || chr(9), '^\\s+', ''), '\\s+$', '')) AS category
FROM events""")
def q_prj21(spark, d):
    """PRJ21: strip all white space at both ends, lower-case."""
    from supplyscope.functions.columns import strip_lower
    return src.browse_log(spark, d).select("event_id", strip_lower("Category").alias("category"))


# ---------------------------------------------------------------- derived tables

@register("agg1_inventory", with_(INVENTORY) + f"\nSELECT {', '.join(INV_COLS)} FROM inventory_t")
def q_agg1(spark, d):
    """AGG1 + AGG2 + PRJ29 + PRJ32-35 + SMP4: the inventory table."""
    return inventory(spark, d)


@register("agg2_span_days", with_(INVENTORY) + "\nSELECT d AS span_days FROM span")
def q_agg2(spark, d):
    it = items(spark, d)
    return it.select(F.greatest(F.timestamp_diff("DAY", F.min("order_date"), F.max("order_date")),
                                F.lit(1)).alias("span_days"))


@register("smp4_supply_days", with_(INVENTORY) + "\nSELECT product_name, CAST(supply AS INTEGER) AS supply_days FROM inv1")
def q_smp4(spark, d):
    from supplyscope.functions.columns import supply_days
    return items(spark, d).select("product_name").distinct().select(
        "product_name", supply_days("product_name").alias("supply_days"))


WEEKLY_COLS = ["product_name", "category", "market", "order_year", "order_week", "order_month",
               "order_season", "weekly_qty", "weekly_sales", "weekly_orders", "lag_1", "lag_2", "ds"]


@register("agg3_weekly_demand", with_(WEEKLY) + f"\nSELECT {', '.join(WEEKLY_COLS)} FROM weekly")
def q_agg3(spark, d):
    """AGG3 + WIN1 + PRJ22: weekly demand with row lags and the Monday key."""
    return weekly(spark, d).select(*WEEKLY_COLS)


@register("snk5_weekly_table", with_(WEEKLY) + """
SELECT product_name, order_year AS year, order_week AS week, CAST(weekly_qty AS DOUBLE) AS total_quantity,
       weekly_sales AS total_sales FROM weekly""")
def q_snk5(spark, d):
    return tables.weekly_table(weekly(spark, d))


@register("win1_true_week_lags", with_(ITEMS) + """,
w0 AS (SELECT product_name, CAST(date_trunc('week', order_date) AS DATE) AS week_start,
              CAST(sum(quantity) AS BIGINT) AS weekly_qty FROM items GROUP BY 1, 2)
SELECT product_name, week_start, weekly_qty,
       coalesce(lag(weekly_qty, 1) OVER w, 0) AS lag_1, coalesce(lag(weekly_qty, 2) OVER w, 0) AS lag_2
FROM w0 WINDOW w AS (PARTITION BY product_name ORDER BY week_start)""")
def q_win1(spark, d):
    return tables.weekly_true_week(items(spark, d))


@register("agg13_demand_baseline", with_(WEEKLY) + """
SELECT product_name, CAST(round_even(CAST(avg(weekly_qty) AS DECIMAL(38,10)), 1) AS DOUBLE) AS baseline
FROM weekly GROUP BY product_name""")
def q_agg13(spark, d):
    return tables.demand_baseline(weekly(spark, d))


@register("agg14_global_weekly", with_(WEEKLY) + """
SELECT ds, CAST(sum(weekly_qty) AS BIGINT) AS y FROM weekly GROUP BY ds""")
def q_agg14(spark, d):
    return tables.global_weekly(weekly(spark, d))


BROWSE_SQL = """
cat AS (SELECT lower(regexp_replace(regexp_replace('  ' || upper(CASE event_type WHEN 'click' THEN 'promo' WHEN 'purchase' THEN 'large' WHEN 'view' THEN 'medium' WHEN 'signup' THEN 'standard' ELSE event_type END) || ' ' || chr(9), '^\\s+', ''), '\\s+$', '')) AS category,
               lower(regexp_replace(regexp_replace(' ' || upper('dept ' || json_extract_string(props, '$.k')) || '  ', '^\\s+', ''), '\\s+$', '')) AS department
        FROM events),
cat_b AS (SELECT category, count(*) AS browse_count FROM cat WHERE category IS NOT NULL GROUP BY category),
dep_b AS (SELECT department, count(*) AS browse_count FROM cat WHERE department IS NOT NULL GROUP BY department)"""


@register("agg4_win2_browse_category", with_(BROWSE_SQL) + """
SELECT category, browse_count, CAST(row_number() OVER (ORDER BY browse_count DESC, category ASC) AS INTEGER) AS browse_rank FROM cat_b""")
def q_browse_cat(spark, d):
    """AGG4 + WIN2: browse counts and ranks by category."""
    return tables.browse_signals(src.browse_log(spark, d), "Category", "category")


@register("agg4_win2_browse_department", with_(BROWSE_SQL) + """
SELECT department, browse_count, CAST(row_number() OVER (ORDER BY browse_count DESC, department ASC) AS INTEGER) AS browse_rank FROM dep_b""")
def q_browse_dep(spark, d):
    return tables.browse_signals(src.browse_log(spark, d), "Department", "department")


@register("top9_top_browsed", with_(BROWSE_SQL) + """
SELECT * FROM (SELECT category, browse_count, CAST(row_number() OVER (ORDER BY browse_count DESC, category ASC) AS INTEGER) AS browse_rank FROM cat_b)
WHERE browse_rank <= 5""")
def q_top9(spark, d):
    return tables.top_browsed(tables.browse_signals(src.browse_log(spark, d), "Category", "category"), 5)


@register("jon8_browse_join", with_(INVENTORY, BROWSE_SQL) + """,
cb AS (SELECT category AS bc, browse_count, CAST(row_number() OVER (ORDER BY browse_count DESC, category ASC) AS INTEGER) AS browse_rank FROM cat_b)
SELECT i.product_name, i.category, cb.browse_count, cb.browse_rank
FROM inventory_t i LEFT JOIN cb ON lower(trim(i.category)) = cb.bc""")
def q_jon8(spark, d):
    """JON8: browse rank joined to the product's category (left)."""
    cat = tables.browse_signals(src.browse_log(spark, d), "Category", "category")
    return tables.browse_join(inventory(spark, d), cat).select(
        "product_name", "category", "browse_count", "browse_rank")


# ---------------------------------------------------------------- sampling

SMP_SQL = ITEMS + """,
hashed AS (SELECT *, md5('42|' || """ + SEQ_TEXT + """) AS h FROM items)"""


@register("smp1_fraud_plus_sample", with_(SMP_SQL) + """
SELECT order_id, line_number, part_key, supp_key, order_status FROM hashed WHERE order_status = 'SUSPECTED_FRAUD'
UNION ALL
SELECT order_id, line_number, part_key, supp_key, order_status FROM
  (SELECT * FROM hashed WHERE order_status <> 'SUSPECTED_FRAUD' ORDER BY h LIMIT 6000)""")
def q_smp1(spark, d):
    """SMP1 + SET1: all fraud rows + 6000 hash-drawn others."""
    return sampling.fraud_plus_sample(draw_lines(spark, d)).select(*KEYS, "order_status")


@register("smp2_stratified_sample", with_(SMP_SQL) + """,
nf AS (SELECT count(*) FILTER (WHERE order_status = 'SUSPECTED_FRAUD') AS nfraud,
              count(*) FILTER (WHERE order_status <> 'SUSPECTED_FRAUD') AS nrest FROM items),
q AS (SELECT order_status, least(greatest(CAST(trunc(count(*) / (SELECT nrest FROM nf)
              * greatest(4000 - (SELECT nfraud FROM nf), 1000)) AS BIGINT), 10), count(*)) AS quota
      FROM items WHERE order_status <> 'SUSPECTED_FRAUD' GROUP BY order_status),
r AS (SELECT h.*, q.quota, row_number() OVER (PARTITION BY h.order_status ORDER BY h.h) AS rn
      FROM hashed h JOIN q ON h.order_status = q.order_status)
SELECT order_id, line_number, part_key, supp_key, order_status FROM hashed WHERE order_status = 'SUSPECTED_FRAUD'
UNION ALL
SELECT order_id, line_number, part_key, supp_key, order_status FROM r WHERE rn <= quota""")
def q_smp2(spark, d):
    """SMP2 + SET2: stratified sample (a hash cutoff per stratum)."""
    return sampling.stratified_sample(draw_lines(spark, d)).select(*KEYS, "order_status")


@register("smp3_train_test_split", with_(SMP_SQL) + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY late_delivery_risk ORDER BY h) AS rn,
                  count(*) OVER (PARTITION BY late_delivery_risk) AS n FROM hashed)
SELECT order_id, line_number, part_key, supp_key, late_delivery_risk, CAST(rn <= ceil(n * 0.2) AS INTEGER) AS is_test FROM ranked""")
def q_smp3(spark, d):
    """SMP3: every line with its side; ceil(0.2 n) test lines of each class."""
    return sampling.train_test_split(draw_lines(spark, d)).select(*KEYS, "late_delivery_risk", "is_test")


# ---------------------------------------------------------------- CSV sources

def _csv_folder(spark, name: str) -> str:
    import uuid
    from supplyscope.session import output_root
    return output_root(spark, f"csv/{name}-{uuid.uuid4().hex[:12]}")


RAW_CSV_COLS = ["order_id", "order_date", "ship_date", "product_name", "category", "department",
                "market", "order_region", "customer_segment", "quantity", "discount_rate", "sales",
                "product_price", "profit", "shipping_mode", "days_scheduled", "days_real",
                "order_status", "delivery_status", "late_delivery_risk"]


@register("src1_order_csv", with_(DIRTY) + """
SELECT CAST(order_id AS VARCHAR) AS order_id, order_date, ship_date, product_name, category, department, market,
       order_region, customer_segment, quantity, discount_rate, sales, product_price, profit, shipping_mode,
       days_scheduled, days_real, order_status, delivery_status, late_delivery_risk
FROM dirty""")
def q_src1(spark, d):
    """SRC1: the dirty order lines written as a Latin-1 CSV with the raw
    headers, read back by ``read_order_csv`` (text, renamed)."""
    inv = {v: k for k, v in src.RAW_TO_ENGINE.items()}
    raw = dirty(spark, d).select(*[F.col(c).cast("string").alias(inv[c]) for c in RAW_CSV_COLS])
    path = _csv_folder(spark, "orders")
    raw.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return src.read_order_csv(spark, path).select(*RAW_CSV_COLS)


@register("src2_access_log_csv", with_(BROWSE_SQL) + """
SELECT category, browse_count FROM cat_b""")
def q_src2(spark, d):
    """SRC2 + AGG4: browse log as CSV, read with the fixed schema, counted."""
    log_ = src.browse_log(spark, d).select(
        F.lit(None).cast("string").alias("Product"), "Category", F.lit(None).cast("string").alias("Date"),
        F.lit(None).cast("string").alias("Month"), F.lit(None).cast("string").alias("Hour"), "Department",
        F.lit(None).cast("string").alias("ip"), F.lit(None).cast("string").alias("url"))
    path = _csv_folder(spark, "access")
    log_.write.option("header", True).option("encoding", "ISO-8859-1").option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    back = src.read_access_log(spark, path)
    return tables.browse_signals(back, "Category", "category").select("category", "browse_count")
