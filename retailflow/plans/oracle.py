"""Independent SQL (DuckDB dialect) for every registered query.

The tables ``region nation customer part orders lineitem events`` are
views over the same parquet files Spark reads. The raw-input derivation of
``retailflow.sources.testdata`` and every pipeline step are restated here
as plain SQL, so a mismatch points at a real semantic difference.

Type conventions shared with the Spark side: money is DECIMAL through the
whole chain and DOUBLE in the output; averages are sum / count in double;
counts and integer sums are BIGINT; calendar parts, day differences and
ranks are INTEGER.
"""

from __future__ import annotations

AS_OF = "DATE '2005-01-01'"
ORDER_DATE_DEFAULT = "DATE '2000-01-01'"
REGISTRATION_DEFAULT = "DATE '2020-01-01'"


def _money(cents_sql: str) -> str:
    return f"CAST(CAST({cents_sql} AS BIGINT) * 0.01 AS DECIMAL(18,2))"


def _mixed_date(c: str) -> str:
    return (
        f"CAST(coalesce(try_strptime({c}, '%Y-%m-%d'), try_strptime({c}, '%m/%d/%Y'), "
        f"try_strptime({c}, '%d-%m-%Y'), try_strptime({c}, '%Y%m%d')) AS DATE)"
    )


_CHEAPNESS = (
    "CASE WHEN l.l_orderkey % 150 = 149 THEN 100.0::DOUBLE WHEN l.l_orderkey % 150 = 74 THEN 10.0::DOUBLE "
    "ELSE 1.0::DOUBLE END"
)
_PRICE = _money("round(p_retailprice * 100.0)")
_REG = "(DATE '2020-01-01' + CAST(c_custkey % 1461 AS INTEGER))"

CTES = f"""
geo_raw AS (
  SELECT CASE WHEN n.n_nationkey = 24 THEN NULL ELSE CAST(n.n_nationkey + 1 AS BIGINT) END AS geography_id,
         r.r_name AS country, n.n_name AS state,
         'City_' || CAST(n.n_nationkey AS VARCHAR) AS city,
         CASE WHEN n.n_nationkey % 10 = 3 THEN NULL
              ELSE ' ab ' || CAST(n.n_nationkey + 10000 AS VARCHAR) || ' ' END AS postal_code
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
prod_raw AS (
  SELECT CASE WHEN p_partkey % 150 = 149 THEN NULL ELSE CAST(p_partkey + 1 AS BIGINT) END AS product_id, p_name AS product_name,
         CASE WHEN p_partkey % 40 = 8 THEN NULL
              WHEN p_partkey % 20 = 1 THEN -{_PRICE}
              ELSE {_PRICE} END AS price,
         {_money("floor(p_retailprice * 60.0)")} AS cost,
         CASE WHEN p_partkey % 33 = 2 THEN NULL ELSE CAST(p_partkey % 50 + 1 AS DOUBLE) END AS supplier_id,
         CASE WHEN p_partkey % 12 = 5 THEN NULL ELSE p_type END AS category
  FROM part
),
cust_raw AS (
  SELECT CAST(CASE WHEN c_custkey % 120 = 119 THEN NULL WHEN c_custkey % 100 = 70 THEN c_custkey
                   ELSE c_custkey + 1 END AS BIGINT) AS customer_id,
         CASE WHEN c_custkey % 90 = 4 THEN NULL ELSE 'First' || CAST(c_custkey % 10 AS VARCHAR) END AS first_name,
         CASE WHEN c_custkey % 90 = 4 THEN NULL ELSE c_mktsegment END AS last_name,
         'customer_' || CAST(c_custkey + 1 AS VARCHAR) || '@example.com' AS email,
         CASE WHEN c_custkey % 20 = 6 THEN NULL
              WHEN c_custkey % 20 = 7 THEN 'n/a'
              ELSE '(555) ' || CAST(c_custkey + 1000000 AS VARCHAR) END AS phone,
         CASE WHEN c_custkey % 33 = 1 THEN NULL ELSE CAST(c_nationkey + 1 AS DOUBLE) END AS geography_id,
         CASE WHEN c_custkey % 30 = 0 THEN strftime({_REG}, '%m/%d/%Y')
              WHEN c_custkey % 30 = 1 THEN strftime({_REG}, '%d-%m-%Y')
              WHEN c_custkey % 30 = 2 THEN 'invalid_date'
              ELSE strftime({_REG}, '%Y-%m-%d') END AS registration_date
  FROM customer
),
ord_raw AS (
  SELECT l.l_orderkey AS order_id,
         CASE WHEN l.l_orderkey % 100 = 7 THEN NULL
              WHEN l.l_orderkey % 75 = 74 THEN CAST(-(o.o_custkey + 1) AS DOUBLE)
              ELSE CAST(o.o_custkey + 1 AS DOUBLE) END AS customer_id,
         CAST(CASE WHEN l.l_orderkey % 50 = 49 THEN -(l.l_partkey + 1) ELSE l.l_partkey + 1 END AS BIGINT) AS product_id,
         CASE WHEN l.l_orderkey % 20 = 0 THEN strftime(o.o_orderdate, '%m/%d/%Y')
              WHEN l.l_orderkey % 20 = 1 THEN strftime(o.o_orderdate, '%d-%m-%Y')
              WHEN l.l_orderkey % 20 = 2 THEN strftime(o.o_orderdate, '%Y%m%d')
              WHEN l.l_orderkey % 20 = 3 THEN 'invalid'
              ELSE strftime(o.o_orderdate, '%Y-%m-%d') END AS order_date,
         CASE WHEN l.l_orderkey % 50 = 9 THEN -CAST(l.l_quantity AS BIGINT)
              WHEN l.l_orderkey % 70 = 21 THEN NULL
              ELSE CAST(l.l_quantity AS BIGINT) END AS quantity,
         CASE WHEN l.l_orderkey % 200 IN (13, 149) THEN NULL
              ELSE {_money("floor(l.l_extendedprice * 100.0 / l.l_quantity / " + _CHEAPNESS + ")")} END AS unit_price,
         CASE WHEN l.l_orderkey % 25 = 4 THEN NULL
              WHEN l.l_orderkey % 100 = 11 OR l.l_orderkey % 200 = 99 THEN CAST(1.50 AS DECIMAL(18,2))
              ELSE {_money("round(l.l_discount * 100.0)")} END AS discount,
         CASE WHEN l.l_orderkey % 50 = 17 THEN NULL
              ELSE {_money("round(l.l_tax * 100.0 * 100.0)")} END AS shipping_cost
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
),
json_raw AS (
  SELECT CASE WHEN event_id % 100 = 5 THEN NULL ELSE event_id + 1 END AS order_id,
         CASE WHEN event_id % 50 = 7 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+05:00'
              WHEN event_id % 50 = 8 THEN CAST(1640390400 + (event_id - 500) * 600 AS VARCHAR)
              WHEN event_id % 50 = 9 THEN '2019-06-01 12:00:00'
              WHEN event_id % 50 = 10 THEN 'not a time'
              WHEN event_id % 50 = 11 THEN strftime(ts, '%Y%m%d%H%M%S')
              WHEN event_id % 50 = 12
              THEN CAST((1640390400 + (event_id - 500) * 600) * 1000 + event_id % 1000 AS VARCHAR)
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS order_timestamp,
         user_id AS customer_id, props AS notifications
  FROM events
),
geo_bronze AS (
  SELECT geography_id, country, state, city, postal_code FROM geo_raw
),
prod_bronze AS (
  SELECT product_id, product_name, price, cost, CAST(supplier_id AS BIGINT) AS supplier_id, category
  FROM prod_raw
),
cust_bronze AS (
  SELECT customer_id, first_name, last_name, email,
         TRY_CAST(regexp_replace(phone, '[^0-9]', '', 'g') AS BIGINT) AS phone,
         CAST(geography_id AS BIGINT) AS geography_id,
         {_mixed_date("registration_date")} AS registration_date
  FROM cust_raw
),
ord_bronze AS (
  SELECT order_id, CAST(customer_id AS BIGINT) AS customer_id, product_id, quantity,
         unit_price, discount, shipping_cost, {_mixed_date("order_date")} AS order_date
  FROM ord_raw
),
geo_silver AS (
  SELECT geography_id, country, state, city,
         upper(replace(trim(postal_code), ' ', '')) AS postal_code
  FROM geo_bronze WHERE geography_id IS NOT NULL
),
prod_imputed AS (
  SELECT product_id, product_name,
         CASE WHEN price IS NULL THEN cost * 1.5 ELSE price END AS price,
         cost, coalesce(supplier_id, 0) AS supplier_id, coalesce(category, 'UNKNOWN') AS category
  FROM prod_bronze WHERE product_id IS NOT NULL
),
prod_silver AS (
  SELECT *, CASE WHEN price > 0 THEN (CAST(price - cost AS DOUBLE) / CAST(price AS DOUBLE)) * 100.0
                 ELSE 0.0 END AS profit_margin_pct
  FROM prod_imputed
),
dim_cust AS (
  SELECT c.customer_id, concat_ws(' ', c.first_name, c.last_name) AS full_name,
         c.first_name, c.last_name, coalesce(c.geography_id, 0) AS geography_id,
         coalesce(g.country, 'Unknown') AS country, coalesce(g.state, 'Unknown') AS state,
         coalesce(g.city, 'Unknown') AS city,
         coalesce(c.registration_date, {REGISTRATION_DEFAULT}) AS registration_date, c.phone
  FROM cust_bronze c LEFT JOIN geo_silver g ON c.geography_id = g.geography_id
  WHERE c.customer_id IS NOT NULL
),
ord_silver AS (
  SELECT o.order_id, coalesce(o.order_date, {ORDER_DATE_DEFAULT}) AS order_date,
         coalesce(o.customer_id, 0) AS customer_id, coalesce(o.product_id, 0) AS product_id,
         coalesce(o.quantity, 1) AS quantity, coalesce(o.unit_price, p.price) AS unit_price,
         least(coalesce(o.discount, 0.0), 1.0) AS discount, coalesce(o.shipping_cost, 0.0) AS shipping_cost,
         p.product_name, p.category, p.price, p.cost, c.full_name, c.country, c.state, c.city
  FROM ord_bronze o
  LEFT JOIN prod_silver p ON o.product_id = p.product_id
  LEFT JOIN dim_cust c ON o.customer_id = c.customer_id
),
enriched AS (
  SELECT *, quantity * unit_price * (1.0 - discount) AS total_amount,
         quantity * unit_price * discount AS discount_amount,
         (unit_price - cost) * quantity * (1.0 - discount) AS profit,
         year(order_date) AS year, month(order_date) AS month, quarter(order_date) AS quarter,
         strftime(order_date, '%b') AS month_name
  FROM ord_silver
),
json_bronze AS (
  SELECT order_id, order_timestamp, customer_id, notifications FROM json_raw
),
json_silver AS (
  SELECT order_id,
         CASE WHEN regexp_full_match(order_timestamp, '[0-9]{{1,11}}')
              THEN make_timestamp(CAST(order_timestamp AS BIGINT) * 1000000)
              WHEN regexp_full_match(order_timestamp, '[0-9]{{12,13}}')
              THEN make_timestamp(CAST(order_timestamp AS BIGINT) * 1000)
              WHEN regexp_full_match(order_timestamp, '[0-9]+') THEN NULL
              WHEN regexp_matches(order_timestamp, '[+-][0-9][0-9]:00$')
              THEN strptime(left(order_timestamp, 19), '%Y-%m-%dT%H:%M:%S')
                   - CAST(left(right(order_timestamp, 6), 3) AS INTEGER) * INTERVAL 1 HOUR
              ELSE TRY_CAST(order_timestamp AS TIMESTAMP) END AS order_timestamp, customer_id, notifications
  FROM json_bronze
)
"""


def _q(body: str) -> str:
    return f"WITH {CTES.strip()}\n{body.strip()}"


def _margin(profit: str = "sum(profit)", revenue: str = "sum(total_amount)") -> str:
    return (
        f"CASE WHEN {revenue} > 0 THEN (CAST({profit} AS DOUBLE) / CAST({revenue} AS DOUBLE)) * 100.0 "
        f"ELSE 0.0 END AS profit_margin_pct"
    )


def _avg(c: str) -> str:
    return f"CAST(sum({c}) AS DOUBLE) / count({c})"


ORDER_SILVER_OUT = """
SELECT order_id, order_date, customer_id, product_id, quantity,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount AS DOUBLE) AS discount,
       CAST(shipping_cost AS DOUBLE) AS shipping_cost, product_name, category,
       CAST(price AS DOUBLE) AS price, CAST(cost AS DOUBLE) AS cost,
       full_name, country, state, city
"""

SALES_BY_DATE = f"""
SELECT order_date, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month,
       CAST(quarter AS INTEGER) AS quarter,
       count(order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_quantity,
       CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
       CAST(sum(discount_amount) AS DOUBLE) AS total_discount,
       CAST(sum(shipping_cost) AS DOUBLE) AS total_shipping,
       CAST(sum(profit) AS DOUBLE) AS total_profit,
       {_avg("total_amount")} AS avg_order_value,
       count(DISTINCT customer_id) AS unique_customers,
       count(DISTINCT product_id) AS unique_products,
       {_margin()}
FROM enriched GROUP BY order_date, year, month, quarter
"""

SALES_BY_CATEGORY = f"""
SELECT category, count(order_id) AS total_orders,
       CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
       CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
       CAST(sum(profit) AS DOUBLE) AS total_profit,
       {_avg("total_amount")} AS avg_order_value,
       {_avg("unit_price")} AS avg_unit_price,
       count(DISTINCT product_id) AS unique_products,
       count(DISTINCT customer_id) AS unique_customers,
       {_margin()},
       (CAST(sum(total_amount) AS DOUBLE) / CAST(sum(sum(total_amount)) OVER () AS DOUBLE)) * 100.0
         AS revenue_share_pct
FROM enriched GROUP BY category
"""

SALES_BY_GEOGRAPHY = f"""
SELECT country, state, city, count(order_id) AS total_orders,
       CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
       CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
       CAST(sum(profit) AS DOUBLE) AS total_profit,
       {_avg("total_amount")} AS avg_order_value,
       count(DISTINCT customer_id) AS unique_customers,
       count(DISTINCT product_id) AS unique_products,
       {_margin()}
FROM enriched GROUP BY country, state, city
"""

CUSTOMER_ANALYTICS = f"""
SELECT customer_id, full_name, country, state, city, count(order_id) AS total_orders,
       CAST(sum(quantity) AS BIGINT) AS total_items_purchased,
       CAST(sum(total_amount) AS DOUBLE) AS lifetime_value,
       {_avg("total_amount")} AS avg_order_value,
       min(order_date) AS first_order_date, max(order_date) AS last_order_date,
       count(DISTINCT product_id) AS unique_products_purchased,
       count(DISTINCT category) AS unique_categories_purchased,
       CAST(datediff('day', min(order_date), {AS_OF}) AS INTEGER) AS days_since_first_order,
       CAST(datediff('day', max(order_date), {AS_OF}) AS INTEGER) AS days_since_last_order,
       CASE WHEN sum(total_amount) >= 10000 THEN 'VIP'
            WHEN sum(total_amount) >= 5000 THEN 'Premium'
            WHEN sum(total_amount) >= 1000 THEN 'Regular'
            ELSE 'New' END AS customer_segment
FROM enriched GROUP BY customer_id, full_name, country, state, city
"""

PRODUCT_PERFORMANCE = f"""
SELECT product_id, product_name, category, count(order_id) AS total_orders,
       CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
       CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
       CAST(sum(profit) AS DOUBLE) AS total_profit,
       {_avg("unit_price")} AS avg_selling_price,
       CAST(min(unit_price) AS DOUBLE) AS min_price,
       CAST(max(unit_price) AS DOUBLE) AS max_price,
       count(DISTINCT customer_id) AS unique_customers,
       {_margin()},
       CAST(CAST(sum(quantity) AS BIGINT) AS DOUBLE) / CAST(count(order_id) AS DOUBLE) AS avg_quantity_per_order,
       CAST(dense_rank() OVER (ORDER BY sum(total_amount) DESC NULLS LAST) AS INTEGER) AS product_rank
FROM enriched GROUP BY product_id, product_name, category
"""

MONTHLY_SALES_TREND = f"""
SELECT CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month,
       CAST(quarter AS INTEGER) AS quarter, month_name,
       count(order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_quantity,
       CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
       CAST(sum(profit) AS DOUBLE) AS total_profit,
       {_avg("total_amount")} AS avg_order_value,
       count(DISTINCT customer_id) AS unique_customers,
       count(DISTINCT product_id) AS unique_products,
       {_margin()}
FROM enriched GROUP BY year, month, quarter, month_name
"""

ORDERS_BY_DATE = """
SELECT CAST(order_timestamp AS DATE) AS order_date, count(*) AS total_daily_orders
FROM json_silver GROUP BY CAST(order_timestamp AS DATE)
"""


def oracle_queries() -> dict[str, str]:
    q = {
        "clean_order_dates": _q(
            f"SELECT order_id, order_date AS order_date_text, {_mixed_date('order_date')} AS order_date FROM ord_raw"
        ),
        "clean_phone": _q(
            "SELECT customer_id, phone AS phone_text, "
            "TRY_CAST(regexp_replace(phone, '[^0-9]', '', 'g') AS BIGINT) AS phone FROM cust_raw"
        ),
        "clean_postal": _q(
            "SELECT geography_id, postal_code AS postal_text, "
            "upper(replace(trim(postal_code), ' ', '')) AS postal_code FROM geo_raw"
        ),
        "geography_bronze": _q("SELECT * FROM geo_bronze"),
        "geography_silver": _q("SELECT * FROM geo_silver"),
        "product_bronze": _q(
            "SELECT product_id, product_name, CAST(price AS DOUBLE) AS price, CAST(cost AS DOUBLE) AS cost, "
            "supplier_id, category FROM prod_bronze"
        ),
        "product_silver": _q(
            "SELECT product_id, product_name, CAST(price AS DOUBLE) AS price, CAST(cost AS DOUBLE) AS cost, "
            "supplier_id, category, profit_margin_pct FROM prod_silver"
        ),
        "customer_bronze": _q("SELECT * FROM cust_bronze"),
        "dim_customer": _q("SELECT * FROM dim_cust"),
        "orders_bronze": _q(
            "SELECT order_id, customer_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, "
            "CAST(discount AS DOUBLE) AS discount, CAST(shipping_cost AS DOUBLE) AS shipping_cost, order_date "
            "FROM ord_bronze"
        ),
        "orders_silver": _q(ORDER_SILVER_OUT + " FROM ord_silver"),
        "orders_silver_shuffle_join": _q(ORDER_SILVER_OUT + " FROM ord_silver"),
        "orders_enriched": _q(
            ORDER_SILVER_OUT
            + """, CAST(total_amount AS DOUBLE) AS total_amount,
                 CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(profit AS DOUBLE) AS profit,
                 CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month,
                 CAST(quarter AS INTEGER) AS quarter, month_name FROM enriched"""
        ),
        "sales_by_date": _q(SALES_BY_DATE),
        "sales_by_category": _q(SALES_BY_CATEGORY),
        "sales_by_geography": _q(SALES_BY_GEOGRAPHY),
        "customer_analytics": _q(CUSTOMER_ANALYTICS),
        "product_performance": _q(PRODUCT_PERFORMANCE),
        "monthly_sales_trend": _q(MONTHLY_SALES_TREND),
        "json_orders_bronze": _q("SELECT * FROM json_bronze"),
        "json_orders_silver": _q("SELECT * FROM json_silver"),
        "orders_by_date": _q(ORDERS_BY_DATE),
        "orders_by_date_sql": _q(ORDERS_BY_DATE),
        "expect_drop_null_id": _q("SELECT * FROM json_bronze WHERE coalesce(order_id IS NOT NULL, false)"),
        "expect_drop_old_ts": _q(
            "SELECT * FROM json_silver WHERE coalesce(order_timestamp > TIMESTAMP '2021-12-25', false)"
        ),
        "expect_fail_passes": _q("SELECT * FROM json_silver WHERE order_id IS NOT NULL"),
    }
    q["roundtrip_geographies_csv"] = _q("SELECT * FROM geo_raw")
    q["roundtrip_customers_csv"] = _q(
        "SELECT * REPLACE (CAST(customer_id AS VARCHAR) AS customer_id, CAST(geography_id AS VARCHAR) AS geography_id) "
        "FROM cust_raw"
    )
    q["customer_bronze_dirty"] = """
SELECT CASE WHEN c_custkey % 7 < 2 THEN NULL ELSE c_custkey END AS customer_id, 'First' AS first_name,
       c_mktsegment AS last_name, CAST(NULL AS VARCHAR) AS email, CAST(5551 AS BIGINT) AS phone,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_nationkey + 1 AS BIGINT) END AS geography_id,
       CASE c_custkey % 7 WHEN 0 THEN 'X' || c_custkey WHEN 1 THEN c_custkey || '.5' WHEN 2 THEN c_custkey || '.0'
            ELSE CAST(c_custkey AS VARCHAR) END AS customer_id_text,
       CASE WHEN c_custkey % 5 = 0 THEN 'unknown' ELSE CAST(CAST(c_nationkey + 1 AS DOUBLE) AS VARCHAR) END AS geography_id_text,
       DATE '2021-02-03' AS registration_date
FROM customer
"""
    q["geography_bronze_by_header"] = _q(
        "SELECT CASE WHEN geography_id % 5 = 0 THEN NULL ELSE geography_id END AS geography_id, country, state, city, "
        "postal_code, lower(state) AS region_name, CASE WHEN geography_id % 5 = 0 THEN 'X' || geography_id "
        "ELSE CAST(CAST(geography_id AS DOUBLE) AS VARCHAR) END AS geography_id_text FROM geo_raw"
    )
    q["json_orders_dirty"] = r"""
WITH t AS (
  SELECT *, CASE WHEN event_id % 50 = 7 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+05:00'
              WHEN event_id % 50 = 8 THEN CAST(1640390400 + (event_id - 500) * 600 AS VARCHAR)
              WHEN event_id % 50 = 9 THEN '2019-06-01 12:00:00'
              WHEN event_id % 50 = 10 THEN 'not a time'
              WHEN event_id % 50 = 11 THEN strftime(ts, '%Y%m%d%H%M%S')
              WHEN event_id % 50 = 12
              THEN CAST((1640390400 + (event_id - 500) * 600) * 1000 + event_id % 1000 AS VARCHAR)
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS time_text,
         CASE WHEN event_id % 7 = 0 THEN 'A-' || event_id WHEN event_id % 7 = 2 THEN NULL
              ELSE CAST(event_id AS VARCHAR) END AS id_text
  FROM events
),
w AS (
  SELECT *, '{"customer_id":' || coalesce(CAST(user_id AS VARCHAR), 'null') || ','
         || CASE WHEN event_id % 3 = 0 THEN '"extra":{"rank":' || event_id || ',"tags":["a","b"]},' ELSE '' END
         || '"notifications":' || coalesce('"' || replace(replace(props, '\', '\\'), '"', '\"') || '"', 'null')
         || ',"order_id":' || CASE WHEN event_id % 7 < 2 THEN '"' || id_text || '"' ELSE coalesce(id_text, 'null') END
         || ',"order_timestamp":"' || time_text || '"}' AS line,
         event_id % 11 = 0 AS broken
  FROM t
)
SELECT CASE WHEN NOT broken AND event_id % 7 NOT IN (0, 2) THEN event_id END AS order_id,
       CASE WHEN NOT broken THEN id_text END AS order_id_text,
       CASE WHEN NOT broken THEN user_id END AS customer_id,
       CASE WHEN NOT broken THEN props END AS notifications,
       CASE WHEN broken THEN NULL
            WHEN regexp_full_match(time_text, '[0-9]{1,11}') THEN make_timestamp(CAST(time_text AS BIGINT) * 1000000)
            WHEN regexp_full_match(time_text, '[0-9]{12,13}') THEN make_timestamp(CAST(time_text AS BIGINT) * 1000)
            WHEN regexp_full_match(time_text, '[0-9]+') THEN NULL
            WHEN time_text LIKE '%+05:00' THEN strptime(left(time_text, 19), '%Y-%m-%dT%H:%M:%S') - INTERVAL 5 HOUR
            ELSE TRY_CAST(time_text AS TIMESTAMP) END AS order_timestamp,
       CASE WHEN NOT broken AND event_id % 3 = 0 THEN event_id END AS extra_rank,
       CASE WHEN NOT broken THEN line END AS record,
       CASE WHEN broken THEN left(line, length(line) - 3) END AS broken_line
FROM w
"""
    q["expectation_results"] = _q("""
SELECT 'orders_bronze_demo3' AS dataset, 'valid_order_id' AS rule, 'order_id IS NOT NULL' AS condition, 'drop' AS action,
       count(*) AS rows_seen, count(*) FILTER (order_id IS NULL) AS violations, count(*) FILTER (order_id IS NULL) AS quarantined
FROM json_bronze
UNION ALL
SELECT 'orders_silver_demo3', 'valid_timestamp', 'order_timestamp > ''2021-12-25''', 'drop', count(*), count(*) FILTER (old),
       count(*) FILTER (old)
FROM (SELECT NOT coalesce(order_timestamp > TIMESTAMP '2021-12-25', false) AS old FROM json_silver WHERE order_id IS NOT NULL)
""")
    q["later_columns_customers"] = _q(
        "SELECT b.*, CASE WHEN CAST(regexp_extract(email, '_([0-9]+)@', 1) AS BIGINT) % 2 = 1 THEN lower(last_name) END "
        "AS tier FROM cust_bronze b"
    )
    q["later_columns_orders"] = _q(
        "SELECT order_id, customer_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, "
        "CAST(discount AS DOUBLE) AS discount, CAST(shipping_cost AS DOUBLE) AS shipping_cost, order_date, "
        "CASE WHEN order_id % 2 = 1 THEN 'channel ' || (order_id % 3) END AS channel FROM ord_bronze"
    )
    q["roundtrip_products_by_category"] = _q(
        "SELECT product_id, product_name, CAST(price AS DOUBLE) AS price, CAST(cost AS DOUBLE) AS cost, "
        "supplier_id, category FROM prod_raw"
    )
    q["roundtrip_orders_by_month"] = _q(
        "SELECT order_id, customer_id, product_id, order_date, quantity, CAST(unit_price AS DOUBLE) AS unit_price, "
        "CAST(discount AS DOUBLE) AS discount, CAST(shipping_cost AS DOUBLE) AS shipping_cost, "
        f"strftime({_mixed_date('order_date')}, '%Y-%m') AS year_month FROM ord_raw"
    )
    q["roundtrip_json_orders"] = _q("SELECT * FROM json_raw")
    for t in ("sales_by_date", "sales_by_category", "sales_by_geography", "customer_analytics",
              "product_performance", "monthly_sales_trend", "orders_by_date"):
        q[f"pipeline_{t}"] = q[t]
    q.update(datagen_oracles())
    q.update(provenance_oracles())
    q["stream_product_silver"] = q["product_silver"]
    q["stream_dim_customer"] = q["dim_customer"]
    q["stream_orders_silver"] = q["orders_silver"]
    q["stream_sales_by_category"] = q["sales_by_category"]
    q["stream_json_orders_silver"] = q["json_orders_silver"]
    q["stream_orders_by_date"] = q["orders_by_date"]
    return q


# ---- the generator, restated in SQL ------------------------------------------------


def _gen_uniforms(table: str, gen_id: str, salts: list[str]) -> str:
    """A subquery with a ``gen_id`` for each row of ``table`` and one
    ``u_<salt>`` column per salt: 52 bits of the md5 of id, seed and salt."""
    draws = ", ".join(
        f"CAST(CAST('0x' || substr(md5(gen_id || ':42:{s}'), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0::DOUBLE AS u_{s}"
        for s in salts
    )
    return f"(SELECT gen_id, {draws} FROM (SELECT {gen_id} AS gen_id FROM {table}) ids)"


def _randint(u: str, lo: int, span: str) -> str:
    return f"({lo} + CAST(floor({u} * {span}) AS BIGINT))"


def _cents(u: str, lo: float, hi: float) -> str:
    lo_c, hi_c = round(lo * 100), round(hi * 100)
    return f"(CAST({lo_c} + CAST(floor({u} * {float(hi_c - lo_c + 1)}) AS BIGINT) AS DOUBLE) / 100.0)"


def _pick(u: str, values) -> str:
    arr = ", ".join(f"'{v}'" for v in values)
    return f"([{arr}])[CAST(floor({u} * {len(values)}) AS INTEGER) + 1]"


def _date_text(d: str, u: str, rate: float, layouts: list[str], invalid: str) -> str:
    slots = len(layouts) + 1
    slot = f"CAST(floor({u} / {rate!r} * {slots}) AS INTEGER)"
    parts = [f"WHEN {u} >= {rate!r} THEN strftime({d}, '%Y-%m-%d')"]
    parts += [f"WHEN {slot} = {i} THEN strftime({d}, '{fmt}')" for i, fmt in enumerate(layouts)]
    return "CASE " + " ".join(parts) + f" ELSE '{invalid}' END"


def datagen_oracles() -> dict[str, str]:
    """The generator's rules with their values spelt out."""
    q = {}
    u = _gen_uniforms("nation", "n_nationkey + 1", ["postal", "postal_null"])
    frac = "CAST(gen_id - 1 AS DOUBLE) / CAST((SELECT count(*) FROM nation) AS DOUBLE)"
    q["datagen_geographies"] = f"""
SELECT gen_id AS geography_id,
       CASE WHEN {frac} < 0.6::DOUBLE THEN 'USA' WHEN {frac} < 0.8::DOUBLE THEN 'Canada' ELSE 'Mexico' END AS country,
       (['CA', 'NY', 'TX', 'FL', 'IL'])[((gen_id - 1) % 5) + 1] AS state,
       'City_' || CAST(gen_id AS VARCHAR) AS city,
       CASE WHEN u_postal_null < 0.1::DOUBLE THEN NULL
            ELSE CAST({_randint('u_postal', 10000, '90000')} AS VARCHAR) END AS postal_code
FROM {u} g"""
    u = _gen_uniforms(
        "part", "p_partkey + 1", ["price", "neg_price", "cost", "supplier_null", "supplier", "category_null", "category"]
    )
    price = _cents("u_price", 10, 500)
    categories = ("Electronics", "Clothing", "Food", "Books", "Toys", "Home", "Sports", "Beauty")
    q["datagen_products"] = f"""
SELECT gen_id AS product_id, 'Product_' || CAST(gen_id AS VARCHAR) AS product_name,
       CASE WHEN u_neg_price < 0.05::DOUBLE THEN -{price} ELSE {price} END AS price,
       {_cents('u_cost', 5, 400)} AS cost,
       CASE WHEN u_supplier_null < 0.03::DOUBLE THEN NULL
            ELSE CAST({_randint('u_supplier', 1, '(SELECT count(*) FROM supplier)')} AS DOUBLE) END AS supplier_id,
       CASE WHEN u_category_null < 0.08::DOUBLE THEN NULL ELSE {_pick('u_category', categories)} END AS category
FROM {u} g"""
    u = _gen_uniforms(
        "customer", "c_custkey + 1", ["reg", "ph1", "ph2", "ph3", "first", "last", "phone_null", "geo_null", "geo", "reg_fmt"]
    )
    reg = f"(DATE '2020-01-01' + CAST({_randint('u_reg', 0, '1461')} AS INTEGER))"
    phone = (
        f"printf('%d-%d-%d', {_randint('u_ph1', 100, '900')}, {_randint('u_ph2', 100, '900')}, "
        f"{_randint('u_ph3', 1000, '9000')})"
    )
    first = ("John", "Jane", "Mike", "Sarah", "David", "Emily", "Chris", "Lisa", "Tom", "Amy")
    last = (
        "Smith", "Johnson", "Williams", "Brown", "Jones", "Garcia", "Miller", "Davis", "Rodriguez", "Martinez",
    )
    q["datagen_customers"] = f"""
SELECT gen_id AS customer_id, {_pick('u_first', first)} AS first_name, {_pick('u_last', last)} AS last_name,
       'customer_' || CAST(gen_id AS VARCHAR) || '@example.com' AS email,
       CASE WHEN u_phone_null < 0.05::DOUBLE THEN NULL ELSE {phone} END AS phone,
       CASE WHEN u_geo_null < 0.03::DOUBLE THEN NULL
            ELSE CAST({_randint('u_geo', 1, '(SELECT count(*) FROM nation)')} AS DOUBLE) END AS geography_id,
       {_date_text(reg, 'u_reg_fmt', 0.1, ['%m/%d/%Y', '%d-%m-%Y'], 'invalid_date')} AS registration_date
FROM {u} g"""
    u = _gen_uniforms(
        "lineitem",
        "CAST('0x' || substr(md5(l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey || ':' "
        "|| CAST(l_quantity AS BIGINT)), 1, 13) AS BIGINT)",
        ["date", "qty", "big_disc", "big_disc_v", "disc", "cust_null", "cust", "prod", "date_fmt",
         "neg_qty", "price", "disc_null", "ship_null", "ship"],
    )
    od = f"(DATE '2023-01-01' + CAST({_randint('u_date', 0, '731')} AS INTEGER))"
    qty = _randint("u_qty", 1, "10")
    q["datagen_orders"] = f"""
SELECT gen_id AS order_id,
       CASE WHEN u_cust_null < 0.01::DOUBLE THEN NULL
            ELSE CAST({_randint('u_cust', 1, '(SELECT count(*) FROM customer)')} AS DOUBLE) END AS customer_id,
       {_randint('u_prod', 1, '(SELECT count(*) FROM part)')} AS product_id,
       {_date_text(od, 'u_date_fmt', 0.15, ['%m/%d/%Y', '%d-%m-%Y', '%Y%m%d'], 'invalid')} AS order_date,
       CASE WHEN u_neg_qty < 0.02::DOUBLE THEN -{qty} ELSE {qty} END AS quantity,
       {_cents('u_price', 10, 500)} AS unit_price,
       CASE WHEN u_disc_null < 0.04::DOUBLE THEN NULL
            WHEN u_big_disc < 0.01::DOUBLE THEN {_cents('u_big_disc_v', 1.0, 2.0)}
            ELSE {_cents('u_disc', 0.0, 0.3)} END AS discount,
       CASE WHEN u_ship_null < 0.02::DOUBLE THEN NULL ELSE {_cents('u_ship', 5, 50)} END AS shipping_cost
FROM {u} g"""
    tables = {"geographies": "geography_id", "products": "product_id", "customers": "customer_id", "orders": "order_id"}
    q["datagen_summary"] = " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, count(*) AS row_count, count(DISTINCT {i}) AS distinct_ids FROM ({q[f'datagen_{t}']})"
        for t, i in tables.items()
    )
    iso = r"^\d{4}-\d{2}-\d{2}$"
    faults = (
        ("geographies", "postal_code", "null", "postal_code IS NULL"),
        ("products", "price", "negative", "price < 0"),
        ("products", "category", "null", "category IS NULL"),
        ("products", "supplier_id", "null", "supplier_id IS NULL"),
        ("customers", "registration_date", "date", f"NOT regexp_matches(registration_date, '{iso}')"),
        ("customers", "phone", "null", "phone IS NULL"),
        ("customers", "geography_id", "null", "geography_id IS NULL"),
        ("orders", "order_date", "date", f"NOT regexp_matches(order_date, '{iso}')"),
        ("orders", "quantity", "negative", "quantity < 0"),
        ("orders", "discount", "null", "discount IS NULL"),
        ("orders", "discount", "discount", "discount >= 1"),
        ("orders", "shipping_cost", "null", "shipping_cost IS NULL"),
        ("orders", "customer_id", "null", "customer_id IS NULL"),
    )
    q["datagen_faults"] = " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, '{c}' AS column_name, '{f}' AS fault, count(*) FILTER (WHERE {w}) AS faults "
        f"FROM ({q[f'datagen_{t}']})"
        for t, c, f, w in faults
    )
    q["datagen_layouts"] = f"""
SELECT 'products' AS dataset, category AS partition_value, count(*) AS row_count,
       count(DISTINCT product_id) AS distinct_ids FROM ({q['datagen_products']}) GROUP BY category
UNION ALL
SELECT 'orders', strftime({_mixed_date('order_date')}, '%Y-%m'), count(*), count(DISTINCT order_id)
FROM ({q['datagen_orders']}) GROUP BY 2"""
    return q


def provenance_oracles() -> dict[str, str]:
    q = {
        "provenance_order_months": _q(
            f"SELECT coalesce(strftime({_mixed_date('order_date')}, '%Y-%m'), '__HIVE_DEFAULT_PARTITION__') "
            "AS month_folder, count(*) AS row_count FROM ord_raw GROUP BY 1"
        )
    }
    raw = {
        "customer_bronze_v1": "cust_raw", "geography_bronze_v1": "geo_raw", "orders_bronze_demo3": "json_raw",
        "orders_bronze_v1": "ord_raw", "product_bronze_v1": "prod_raw",
    }
    zero = "CAST(0 AS BIGINT)"
    q["provenance_audit"] = _q(
        " UNION ALL ".join(
            f"SELECT '{d}' AS dataset, count(*) AS row_count, {zero} AS bad_times, {zero} AS bad_sources FROM {t}"
            for d, t in raw.items()
        )
    )
    # Names, comments and qualities of the declared datasets.
    declared = (
        ("geography_bronze_v1", "Raw geography reference data (single CSV)", "bronze", "SELECT 1 FROM geo_raw"),
        ("geography_silver", "Cleaned geography reference data", "silver", "SELECT 1 FROM geo_silver"),
        ("product_bronze_v1", "Raw product data ingested from Parquet files", "bronze", "SELECT 1 FROM prod_raw"),
        ("product_silver_v2", "Cleaned and enriched product dimension", "silver", "SELECT 1 FROM prod_silver"),
        ("customer_bronze_v1", "Raw customer data ingested from CSV files", "bronze", "SELECT 1 FROM cust_raw"),
        ("dim_customer_silver_v2", "Cleaned & enriched customer dimension", "silver", "SELECT 1 FROM dim_cust"),
        ("orders_bronze_v1", "Raw orders data ingested from Parquet files", "bronze", "SELECT 1 FROM ord_raw"),
        ("orders_silver", "Order fact table enriched with dimensions", "silver", "SELECT 1 FROM ord_silver"),
        ("gold_orders_enriched", "Enriched base for gold layer calculations", None, "SELECT 1 FROM enriched"),
        ("sales_by_date", "Daily sales summary with key metrics", "gold", SALES_BY_DATE),
        ("sales_by_category", "Sales performance aggregated by product category", "gold", SALES_BY_CATEGORY),
        ("sales_by_geography", "Sales performance by country/state/city", "gold", SALES_BY_GEOGRAPHY),
        ("customer_analytics", "Customer-level lifetime metrics and segmentation", "gold", CUSTOMER_ANALYTICS),
        ("product_performance", "Product-level sales and profitability metrics", "gold", PRODUCT_PERFORMANCE),
        ("monthly_sales_trend", "Monthly aggregated sales trends", "gold", MONTHLY_SALES_TREND),
        ("orders_bronze_demo3", "Ingest raw JSON order files with data quality checks", "bronze", "SELECT 1 FROM json_raw"),
        ("orders_silver_demo3", "Cleaned and transformed orders data with quality checks", "silver", "SELECT 1 FROM json_raw"),
        ("orders_by_date_gold_demo3", "Daily order aggregations", "gold", ORDERS_BY_DATE),
    )
    q["catalog"] = _q(
        " UNION ALL ".join(
            f"SELECT '{name}' AS dataset, '{comment}' AS comment, "
            + (f"'{quality}'" if quality else "CAST(NULL AS VARCHAR)")
            + f" AS quality, (SELECT count(*) FROM ({body})) AS row_count"
            for name, comment, quality, body in declared
        )
    )
    return q
