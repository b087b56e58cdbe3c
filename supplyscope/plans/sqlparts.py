"""DuckDB SQL building blocks for the oracle queries.

These restate the order-item mapping and the derived tables in plain SQL,
independently of the DataFrame code, so the driver can check every
registered query against DuckDB on the same parquet tables.
"""

ITEMS = """
items0 AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number, l.l_partkey AS part_key,
         l.l_suppkey AS supp_key, o.o_orderdate AS order_date, l.l_shipdate AS ship_date,
         p.p_name AS product_name, p.p_type AS category, p.p_brand AS department,
         r.r_name AS market, n.n_name AS order_region, c.c_mktsegment AS customer_segment,
         CAST(CAST(l.l_quantity AS BIGINT) * CASE length(p.p_name) % 3 WHEN 0 THEN year(o.o_orderdate) - 1993
              WHEN 1 THEN 2003 - year(o.o_orderdate) ELSE 1 END AS BIGINT) AS quantity, l.l_discount AS discount_rate,
         CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * 0.02, 2) AS DOUBLE) AS sales,
         p.p_retailprice AS product_price,
         CAST(ROUND(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * 0.02, 2)
              * (CAST(l.l_tax AS DECIMAL(6,2)) - CAST(l.l_discount AS DECIMAL(6,2))), 2) AS DOUBLE) AS profit,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Same Day' WHEN '2-HIGH' THEN 'First Class'
              WHEN '3-MEDIUM' THEN 'Second Class' ELSE 'Standard Class' END AS shipping_mode,
         CAST(CASE o.o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1
              WHEN '3-MEDIUM' THEN 2 ELSE 4 END AS INTEGER) AS days_scheduled,
         CAST(1 + ((date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) % 6) + 6) % 6
              AS INTEGER) AS days_real,
         CASE WHEN l.l_returnflag = 'R' AND o.o_orderstatus = 'P' AND o.o_orderpriority = '1-URGENT'
              THEN 'SUSPECTED_FRAUD' ELSE o.o_orderstatus END AS order_status,
         l.l_extendedprice AS s_price, l.l_quantity AS s_qty
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
items AS (
  SELECT *,
         CASE WHEN order_status = 'SUSPECTED_FRAUD' THEN 'Shipping canceled'
              WHEN days_real - days_scheduled > 0 THEN 'Late delivery'
              WHEN days_real - days_scheduled = 0 THEN 'Shipping on time'
              ELSE 'Advance shipping' END AS delivery_status,
         CAST(days_real - days_scheduled > 0 AS INTEGER) AS late_delivery_risk
  FROM items0
)"""

# Item order ("file order"), as an ORDER BY list.
SEQ = "order_id, line_number, part_key, supp_key, ship_date, s_price, s_qty"
SEQ_DESC = ", ".join(f"{c} DESC" for c in SEQ.split(", "))
# The same key as the '|'-joined text Spark hashes.
SEQ_TEXT = ("concat_ws('|', CAST(order_id AS VARCHAR), CAST(line_number AS VARCHAR), "
            "CAST(part_key AS VARCHAR), CAST(supp_key AS VARCHAR), "
            "strftime(ship_date, '%Y-%m-%d %H:%M:%S'), CAST(s_price AS VARCHAR), "
            "CAST(s_qty AS VARCHAR))")

FEAT = ITEMS + """,
feat AS (
  SELECT *,
         CAST(year(order_date) AS INTEGER) AS order_year,
         CAST(month(order_date) AS INTEGER) AS order_month,
         CAST(weekofyear(order_date) AS INTEGER) AS order_week,
         CAST(isodow(order_date) - 1 AS INTEGER) AS order_dayofweek,
         CAST((month(order_date) % 12) // 3 + 1 AS INTEGER) AS order_season,
         CAST(days_real - days_scheduled AS DOUBLE) AS delay_days,
         CAST(order_status = 'SUSPECTED_FRAUD' AS INTEGER) AS fraud_label,
         CAST(ROUND(CAST(CASE WHEN sales <> 0 THEN profit / sales * 100 ELSE 0.0 END
              AS DECIMAL(38,10)), 4) AS DOUBLE) AS profit_margin,
         CAST(ROUND(CAST(product_price AS DECIMAL(18,2)) * CAST(discount_rate AS DECIMAL(8,4)), 4)
              AS DOUBLE) AS discount_amount,
         CAST(sales >= (SELECT quantile_cont(sales, 0.75) FROM items) AS INTEGER) AS is_high_value
  FROM items
)"""

INVENTORY = FEAT + """,
span AS (
  SELECT greatest(CAST(floor(date_diff('second', min(order_date), max(order_date)) / 86400) AS BIGINT), 1) AS d
  FROM items
),
inv0 AS (
  SELECT product_name,
         CAST(sum(quantity) AS BIGINT) AS total_sold,
         count(*) AS total_orders,
         avg(quantity) AS avg_per_order,
         first(product_price ORDER BY """ + SEQ + """) AS product_price,
         first(category ORDER BY """ + SEQ + """) AS category,
         first(department ORDER BY """ + SEQ + """) AS department
  FROM items GROUP BY product_name
),
inv1 AS (
  SELECT *,
         CAST(round_even(CAST(total_sold / (SELECT d FROM span) AS DECIMAL(38,10)), 4) AS DOUBLE) AS avg_daily_demand,
         CAST(round_even(CAST(avg_per_order * 7 AS DECIMAL(38,10)), 2) AS DOUBLE) AS reorder_threshold,
         5 + ('0x' || substr(md5(product_name), 1, 8))::BIGINT % 41 AS supply
  FROM inv0
),
inv2 AS (
  SELECT *, greatest(CAST(round_even(CAST(avg_daily_demand AS DECIMAL(20,4)) * supply, 0) AS BIGINT), 1) AS simulated_stock
  FROM inv1
),
inv3 AS (
  SELECT *, CASE WHEN avg_daily_demand > 0
                 THEN CAST(round_even(CAST(simulated_stock / avg_daily_demand AS DECIMAL(38,10)), 1) AS DOUBLE)
                 ELSE 999.0 END AS days_remaining
  FROM inv2
),
inventory_t AS (
  SELECT product_name, total_sold, total_orders, avg_per_order, product_price, category, department,
         simulated_stock, reorder_threshold, avg_daily_demand, days_remaining,
         CASE WHEN days_remaining < 7 THEN 'CRITICAL' WHEN days_remaining < 14 THEN 'WARNING' ELSE 'OK' END AS status
  FROM inv3
)"""

WEEKLY = INVENTORY + """,
weekly0 AS (
  SELECT product_name, category, market, order_year, order_week, order_month, order_season,
         CAST(sum(quantity) AS BIGINT) AS weekly_qty,
         CAST(sum(CAST(sales AS DECIMAL(18,2))) AS DOUBLE) AS weekly_sales,
         count(*) AS weekly_orders
  FROM feat
  GROUP BY product_name, category, market, order_year, order_week, order_month, order_season
),
weekly AS (
  SELECT *,
         coalesce(lag(weekly_qty, 1) OVER w, 0) AS lag_1,
         coalesce(lag(weekly_qty, 2) OVER w, 0) AS lag_2,
         CAST(make_date(order_year, 1, 1) + CAST((8 - isodow(make_date(order_year, 1, 1))) % 7 AS INTEGER)
              + CAST((order_week - 1) * 7 AS INTEGER) AS DATE) AS ds
  FROM weekly0
  WINDOW w AS (PARTITION BY product_name ORDER BY order_year, order_week, category, market, order_month, order_season)
)"""


def with_(*blocks: str) -> str:
    return "WITH " + ",\n".join(b.strip().rstrip(",") for b in blocks)

DIRTY = ITEMS + """,
dirty AS (
  SELECT order_id, line_number, part_key, supp_key, s_price, s_qty, ship_date AS s_ship,
         CASE WHEN part_key % 101 = 3 THEN 'not a date' ELSE strftime(order_date, '%-m/%-d/%Y %-H:%M') END AS order_date,
         CASE WHEN part_key % 103 = 3 THEN NULL ELSE strftime(ship_date, '%-m/%-d/%Y %-H:%M') END AS ship_date,
         product_name,
         CASE WHEN part_key % 83 = 3 THEN NULL ELSE category END AS category,
         department, market, order_region,
         CASE WHEN part_key % 79 = 3 THEN NULL ELSE customer_segment END AS customer_segment,
         CASE WHEN part_key % 89 = 3 THEN NULL ELSE CAST(quantity AS VARCHAR) END AS quantity,
         CASE WHEN part_key % 71 = 3 THEN 'n/a' ELSE CAST(discount_rate AS VARCHAR) END AS discount_rate,
         CASE WHEN part_key % 97 = 3 THEN 'n/a' ELSE CAST(sales AS VARCHAR) END AS sales,
         CAST(product_price AS VARCHAR) AS product_price,
         CASE WHEN part_key % 73 = 3 THEN NULL ELSE CAST(profit AS VARCHAR) END AS profit,
         shipping_mode,
         CAST(days_scheduled AS VARCHAR) AS days_scheduled,
         CASE WHEN part_key % 67 = 3 THEN '?' ELSE CAST(days_real AS VARCHAR) END AS days_real,
         order_status, delivery_status,
         CAST(late_delivery_risk AS VARCHAR) AS late_delivery_risk
  FROM items
),
parsed AS (
  SELECT * REPLACE (
           try_strptime(order_date, '%m/%d/%Y %H:%M') AS order_date,
           try_strptime(ship_date, '%m/%d/%Y %H:%M') AS ship_date,
           TRY_CAST(days_real AS DOUBLE) AS days_real,
           TRY_CAST(days_scheduled AS DOUBLE) AS days_scheduled,
           CAST(trunc(TRY_CAST(quantity AS DOUBLE)) AS BIGINT) AS quantity,
           TRY_CAST(discount_rate AS DOUBLE) AS discount_rate,
           TRY_CAST(sales AS DOUBLE) AS sales,
           TRY_CAST(profit AS DOUBLE) AS profit,
           TRY_CAST(product_price AS DOUBLE) AS product_price,
           CAST(trunc(TRY_CAST(late_delivery_risk AS DOUBLE)) AS BIGINT) AS late_delivery_risk)
  FROM dirty
),
kept AS (SELECT * FROM parsed WHERE order_date IS NOT NULL),
medians AS (
  SELECT quantile_cont(days_real, 0.5) AS days_real, quantile_cont(days_scheduled, 0.5) AS days_scheduled,
         CAST(trunc(quantile_cont(quantity, 0.5)) AS BIGINT) AS quantity,
         quantile_cont(discount_rate, 0.5) AS discount_rate, quantile_cont(sales, 0.5) AS sales,
         quantile_cont(profit, 0.5) AS profit, quantile_cont(product_price, 0.5) AS product_price,
         CAST(trunc(quantile_cont(late_delivery_risk, 0.5)) AS BIGINT) AS late_delivery_risk
  FROM kept
),
cleaned AS (
  SELECT k.order_id, k.line_number, k.part_key, k.supp_key, k.order_date, k.ship_date,
         k.product_name, coalesce(k.category, 'Unknown') AS category, k.department, k.market,
         k.order_region, coalesce(k.customer_segment, 'Unknown') AS customer_segment,
         coalesce(k.quantity, m.quantity) AS quantity,
         coalesce(k.discount_rate, m.discount_rate) AS discount_rate,
         coalesce(k.sales, m.sales) AS sales,
         coalesce(k.product_price, m.product_price) AS product_price,
         coalesce(k.profit, m.profit) AS profit, k.shipping_mode,
         coalesce(k.days_scheduled, m.days_scheduled) AS days_scheduled,
         coalesce(k.days_real, m.days_real) AS days_real,
         k.order_status, k.delivery_status,
         coalesce(k.late_delivery_risk, m.late_delivery_risk) AS late_delivery_risk
  FROM kept k CROSS JOIN medians m
)"""
