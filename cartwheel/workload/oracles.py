"""DuckDB statements that give the rows of the registered queries.

They are written from the meaning of the models, apart from the Spark code:
``TABLES`` holds the inputs and models as named subqueries, ``STATEMENTS`` the
query of each key. A statement is sent with the subqueries it refers to.

Conventions: money is summed as DECIMAL; a rounded quotient is rounded as a
DECIMAL, half away from zero; counts and day numbers get the width Spark uses.
"""

from __future__ import annotations

import re

# The lists that the statements check against, written out here and not taken from the code.
ALLOWED_TABLES = ["mart_sales", "mart_cohorts", "mart_sellers", "mart_price_history", "dim_date"]
FORBIDDEN_KEYWORDS = ["DROP", "DELETE", "INSERT", "UPDATE", "TRUNCATE", "ALTER", "CREATE", "REPLACE"]
LOG_TABLES = ["mart_sales", "mart_cohorts", "MART_SELLERS", "mart_price_history", "dim_date",
              "mart_customers", "raw_orders"]
# Column checks: table, column, whether it is unique, its accepted values.
SOURCE_RULES = [
    ("orders", "order_id", True, None), ("orders", "customer_id", False, None),
    ("orders", "order_status", False,
     ("delivered", "shipped", "canceled", "invoiced", "processing", "approved", "unavailable",
      "created")),
    ("orders", "order_purchase_timestamp", False, None), ("order_items", "order_id", False, None),
    ("order_items", "order_item_id", False, None), ("order_items", "price", False, None),
    ("customers", "customer_id", True, None), ("sellers", "seller_id", True, None),
    ("products", "product_id", True, None), ("order_payments", "order_id", False, None),
    ("reviews", "order_id", False, None),
    ("product_categories", "product_category_name", True, None),
    ("marketplace_products", "product_id", False, None),
]
MART_RULES = [
    ("mart_sales", "order_id", True, None), ("mart_sales", "customer_id", False, None),
    ("mart_sales", "order_date", False, None), ("mart_sales", "total_payment_brl", False, None),
    ("mart_customers", "customer_unique_id", True, None),
    ("mart_customers", "total_orders", False, None), ("mart_customers", "ltv_brl", False, None),
    ("mart_customers", "rfm_segment", False,
     ("champion", "loyal", "at_risk", "hibernating", "new", "lost")),
    ("mart_customers", "r_score", False, None),
    ("mart_customers", "days_since_last_order", False, None),
    ("mart_cohorts", "cohort_month", False, None),
    ("mart_cohorts", "months_since_first_order", False, None),
    ("mart_cohorts", "cohort_size", False, None),
    ("mart_cohorts", "retained_customers", False, None),
    ("mart_cohorts", "retention_rate_pct", False, None),
    ("mart_sellers", "seller_id", True, None), ("mart_sellers", "total_orders", False, None),
    ("mart_sellers", "total_revenue_brl", False, None),
    ("mart_price_history", "product_id", False, None),
    ("mart_price_history", "valid_from", False, None),
    ("mart_price_history", "is_current", False, None),
    ("mart_price_history", "price_change_direction", False,
     ("first_record", "increase", "decrease", "unchanged")),
    ("dim_date", "date_day", True, None), ("dim_date", "year", False, None),
    ("dim_date", "is_weekend", False, None), ("dim_date", "is_holiday_br", False, None),
    ("dim_date", "is_holiday_ar", False, None), ("dim_date", "is_business_day_br", False, None),
    ("mart_customer_features", "customer_unique_id", True, None),
    ("mart_customer_features", "is_churned", False, None),
    ("mart_customer_features", "is_at_risk", False, None),
]


def money(x: str) -> str:
    # Four places keep parts of a cent, and sums below 9e11 convert to DOUBLE without an error.
    return f"CAST(SUM(CAST({x} AS DECIMAL(28,4))) AS DOUBLE)"


def rounded(x: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def over(numerator: str, denominator: str) -> str:
    return f"(CAST({numerator} AS DOUBLE) / NULLIF(CAST({denominator} AS DOUBLE), 0))"


# --- inputs ----------------------------------------------------------------

TABLES: dict[str, str] = {}

TABLES["raw_orders"] = """
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
           CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                              WHEN 'P' THEN 'processing' END AS order_status,
           o_orderdate AS order_purchase_timestamp,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_days(1) END AS order_approved_at,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_days(3) END
               AS order_delivered_carrier_date,
           CASE WHEN o_orderstatus = 'F' AND o_orderkey % 97 <> 0
                THEN o_orderdate + to_days(CAST(5 + o_orderkey % 21 AS INTEGER)) END
               AS order_delivered_customer_date,
           o_orderdate + to_days(CAST(10 + o_custkey % 15 AS INTEGER))
               AS order_estimated_delivery_date
    FROM orders"""

TABLES["places"] = """
    SELECT n_nationkey, n_name AS city, r_name AS state
    FROM nation, region WHERE n_regionkey = r_regionkey"""

TABLES["raw_customers"] = """
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
           CAST(c_custkey // 2 AS VARCHAR) AS customer_unique_id,
           CASE WHEN c_custkey % 101 <> 0
                THEN lpad(CAST(c_custkey * 37 % 100000 AS VARCHAR), 5, '0') END
               AS customer_zip_code_prefix,
           city AS customer_city, state AS customer_state
    FROM customer, places WHERE c_nationkey = n_nationkey"""

TABLES["raw_sellers"] = """
    SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
           lpad(CAST(s_suppkey * 37 % 100000 AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
           city AS seller_city, state AS seller_state
    FROM supplier, places WHERE s_nationkey = n_nationkey"""

TABLES["raw_order_items"] = """
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id,
           CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
           l_shipdate AS shipping_limit_date, l_extendedprice AS price,
           CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)
                AS DOUBLE) AS freight_value
    FROM lineitem"""

TABLES["raw_order_payments"] = """
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
           CAST(l_linenumber AS BIGINT) AS payment_sequential,
           CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'R' THEN 'boleto'
                             WHEN 'N' THEN 'voucher' END AS payment_type,
           CAST(l_quantity AS BIGINT) % 12 + 1 AS payment_installments,
           l_extendedprice AS payment_value
    FROM lineitem"""

TABLES["raw_products"] = """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id,
           CASE WHEN p_partkey % 50 <> 0 THEN p_type END AS product_category_name,
           CAST(length(p_name) AS BIGINT) AS product_name_lenght,
           CAST(length(p_name) + length(p_brand) AS BIGINT) AS product_description_lenght,
           CAST(p_size % 6 AS BIGINT) AS product_photos_qty,
           CAST(p_size * 100 AS DOUBLE) AS product_weight_g,
           CAST(p_size AS DOUBLE) AS product_length_cm,
           CAST(p_size AS DOUBLE) / 2 AS product_height_cm,
           CAST(p_size * 2 AS DOUBLE) AS product_width_cm
    FROM part"""

TABLES["raw_product_categories"] = """
    SELECT DISTINCT p_type AS product_category_name,
           CASE WHEN p_type <> 'PROMO' THEN lower(p_type) END AS product_category_name_english
    FROM part"""

TABLES["raw_reviews"] = """
    SELECT CAST(event_id AS VARCHAR) AS review_id, CAST(event_id // 2 AS VARCHAR) AS order_id,
           CASE WHEN event_type <> 'error' THEN event_id % 5 + 1 END AS review_score,
           event_type AS review_comment_title, props AS review_comment_message,
           ts AS review_creation_date, ts + to_days(1) AS review_answer_timestamp
    FROM events"""

TABLES["raw_marketplace"] = """
    SELECT CAST(user_id AS VARCHAR) AS product_id, CAST(user_id % 5 AS VARCHAR) AS category_id,
           CASE WHEN (user_id // 2) % 5 <> 4
                THEN 'Category ' || CAST((user_id // 2) % 5 AS VARCHAR) END AS category_name,
           'Product ' || CAST(user_id // 2 AS VARCHAR)
               || repeat(' long name', CAST((user_id // 2) % 9 AS INTEGER)) AS name,
           CASE event_type WHEN 'signup' THEN 'paused' ELSE 'active' END AS status,
           'D-' || CAST(user_id % 3 AS VARCHAR) AS domain_id,
           CASE WHEN event_type <> 'error' THEN CAST(floor(value / 50) * 50 + 100 AS DOUBLE) END
               AS min_price_ars,
           'ARS' AS currency, ts AS ingested_at, date_trunc('day', ts)::TIMESTAMP AS run_ts
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC) AS k
          FROM events)
    WHERE k = 1"""

TABLES["audit_log"] = """
    SELECT CASE WHEN turn <> 0 THEN 'user-' || CAST(conv_id % 20 AS VARCHAR) END AS user_id,
           text AS question, 'SELECT ' || CAST(turn AS VARCHAR) AS generated_sql,
           CASE role WHEN 'user' THEN ['mart_sales', 'dim_date'] WHEN 'assistant'
                THEN ['mart_sellers'] ELSE CAST([] AS VARCHAR[]) END AS tables_referenced,
           CASE WHEN role <> 'system' THEN CAST(length(text) AS BIGINT) END AS tokens_used,
           TIMESTAMP '2024-01-31 00:00:00' + to_hours(CAST(conv_id AS INTEGER)) AS created_at
    FROM conversations"""

TABLES["generated_sql"] = f"""
    SELECT event_id, 'SELECT * FROM `p`.dataset_marts.'
           || {LOG_TABLES!r}[CAST(user_id % {len(LOG_TABLES)} AS INTEGER) + 1]
           || CASE event_type WHEN 'click' THEN ' WHERE updated_at > 1'
                  WHEN 'error' THEN '; drop table x'
                  WHEN 'signup' THEN ' JOIN Dataset_Marts.mart_customers USING (id)'
                  WHEN 'purchase' THEN ' -- Replace and CREATE' ELSE '' END AS sql
    FROM events"""

TABLES["replies"] = """
    SELECT conv_id, turn, role, text, (conv_id + turn) % 6 AS kind,
           'SELECT ' || CAST(turn AS VARCHAR)
               || CASE role WHEN 'user' THEN ' FROM dataset_marts.mart_sales'
                       WHEN 'assistant' THEN ' FROM dataset_marts.mart_customers'
                       ELSE '; truncate y' END AS statement
    FROM conversations"""

# --- enriched tables ---------------------------------------------------------

TABLES["oe"] = f"""
    SELECT o.order_id, o.customer_id, c.customer_unique_id, o.order_status,
           order_purchase_timestamp AS purchased_at, order_approved_at AS approved_at,
           order_delivered_carrier_date AS delivered_to_carrier_at,
           order_delivered_customer_date AS delivered_to_customer_at,
           order_estimated_delivery_date AS estimated_delivery_at,
           c.customer_city, c.customer_state,
           COALESCE(paid, 0.0::DOUBLE) AS total_payment_brl, n AS payment_count,
           kind AS primary_payment_type,
           CAST(CAST(order_delivered_customer_date AS DATE)
                - CAST(order_purchase_timestamp AS DATE) AS INTEGER) AS actual_delivery_days,
           CAST(CAST(order_estimated_delivery_date AS DATE)
                - CAST(order_purchase_timestamp AS DATE) AS INTEGER) AS estimated_delivery_days,
           CASE WHEN order_delivered_customer_date IS NULL THEN NULL
                ELSE COALESCE(order_delivered_customer_date <= order_estimated_delivery_date, FALSE)
           END AS is_on_time,
           CAST(order_purchase_timestamp AS DATE) AS order_date
    FROM raw_orders o
    LEFT JOIN raw_customers c ON c.customer_id = o.customer_id
    LEFT JOIN (SELECT order_id, {money('payment_value')} AS paid, COUNT(*) AS n,
                      MAX(payment_type) AS kind
               FROM raw_order_payments GROUP BY 1) p ON p.order_id = o.order_id"""

TABLES["done_orders"] = "SELECT * FROM oe WHERE order_status = 'delivered'"

TABLES["ie"] = """
    SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id,
           i.shipping_limit_date AS shipping_limit_at, i.price AS price_brl,
           i.freight_value AS freight_brl, i.price + i.freight_value AS total_brl,
           p.product_category_name AS category_name_pt,
           COALESCE(k.product_category_name_english, p.product_category_name) AS category_name_en,
           p.product_weight_g AS weight_g, p.product_photos_qty AS photos_qty
    FROM raw_order_items i
    LEFT JOIN raw_products p ON p.product_id = i.product_id
    LEFT JOIN raw_product_categories k ON k.product_category_name = p.product_category_name"""

TABLES["life"] = f"""
    SELECT customer_unique_id, COUNT(DISTINCT order_id) AS total_orders,
           MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
           CAST(MAX(order_date) - MIN(order_date) AS INTEGER) AS customer_age_days,
           {money('total_payment_brl')} AS ltv_brl,
           {money('total_payment_brl')} / COUNT(total_payment_brl) AS avg_order_value_brl,
           CAST(DATE '2001-08-02' - MAX(order_date) AS INTEGER) AS days_since_last_order
    FROM done_orders GROUP BY customer_unique_id"""

TABLES["item_sums"] = f"""
    SELECT order_id, {money('price_brl')} AS items_value_brl,
           {money('freight_brl')} AS freight_value_brl, {money('total_brl')} AS total_items_brl,
           COUNT(DISTINCT product_id) AS unique_products, MAX(category_name_en) AS primary_category
    FROM ie GROUP BY order_id"""

TABLES["review_sums"] = f"""
    SELECT order_id, COUNT(*) AS review_count,
           {rounded(over('SUM(review_score)', 'COUNT(review_score)'), 1)} AS review_score
    FROM raw_reviews GROUP BY order_id"""

TABLES["sales"] = """
    SELECT d.order_id, customer_id, customer_unique_id, order_date, purchased_at,
           delivered_to_customer_at, customer_city, customer_state, primary_category,
           items_value_brl, freight_value_brl, total_payment_brl, unique_products,
           actual_delivery_days, estimated_delivery_days, is_on_time, review_score, review_count,
           primary_payment_type
    FROM done_orders d
    LEFT JOIN item_sums i ON i.order_id = d.order_id
    LEFT JOIN review_sums r ON r.order_id = d.order_id"""

TABLES["scores"] = """
    SELECT *, CAST(NTILE(4) OVER (ORDER BY days_since_last_order DESC NULLS LAST,
                                  customer_unique_id) AS INTEGER) AS r_score,
           CAST(NTILE(4) OVER (ORDER BY total_orders NULLS FIRST,
                               customer_unique_id) AS INTEGER) AS f_score,
           CAST(NTILE(4) OVER (ORDER BY ltv_brl NULLS FIRST,
                               customer_unique_id) AS INTEGER) AS m_score
    FROM life"""

TABLES["person_reviews"] = f"""
    SELECT o.customer_unique_id,
           {rounded(over('SUM(review_score)', 'COUNT(*)'), 2)} AS avg_review_score,
           COUNT(*) AS reviews_count
    FROM oe o JOIN raw_reviews r ON r.order_id = o.order_id
    WHERE r.review_score IS NOT NULL GROUP BY 1"""

TABLES["people"] = f"""
    SELECT s.customer_unique_id, first_order_date, last_order_date, customer_age_days,
           days_since_last_order, total_orders,
           COALESCE({rounded('ltv_brl', 2)}, 0) AS ltv_brl,
           {rounded('avg_order_value_brl', 2)} AS avg_order_value_brl,
           r_score, f_score, m_score, r_score + f_score + m_score AS rfm_total,
           CASE WHEN f_score >= 3 AND m_score >= 3
                THEN CASE WHEN r_score = 4 THEN 'champion' ELSE 'loyal' END
                WHEN r_score <= 2 THEN CASE WHEN f_score >= 3 THEN 'at_risk' ELSE 'hibernating' END
                WHEN f_score <= 2 THEN 'new' ELSE 'lost' END AS rfm_segment,
           avg_review_score, reviews_count
    FROM scores s LEFT JOIN person_reviews p ON p.customer_unique_id = s.customer_unique_id"""

TABLES["cohorts"] = f"""
    WITH firsts AS (SELECT customer_unique_id, date_trunc('month', MIN(order_date)) AS m
                    FROM done_orders GROUP BY 1),
         sizes AS (SELECT m, COUNT(DISTINCT customer_unique_id) AS n FROM firsts GROUP BY 1),
         active AS (SELECT f.m, date_diff('month', f.m, date_trunc('month', d.order_date)) AS k,
                           COUNT(DISTINCT d.customer_unique_id) AS n
                    FROM done_orders d JOIN firsts f ON f.customer_unique_id = d.customer_unique_id
                    GROUP BY 1, 2)
    SELECT CAST(active.m AS DATE) AS cohort_month, CAST(k AS INTEGER) AS months_since_first_order,
           sizes.n AS cohort_size, active.n AS retained_customers,
           {rounded(over('active.n * 100', 'sizes.n'), 2)} AS retention_rate_pct
    FROM active JOIN sizes ON sizes.m = active.m WHERE k BETWEEN 0 AND 12"""

TABLES["seller_totals"] = f"""
    SELECT seller_id, COUNT(DISTINCT product_id) AS unique_products,
           COUNT(DISTINCT category_name_en) AS categories_count,
           {rounded(money('price_brl'), 2)} AS total_revenue_brl,
           {rounded(over(money('price_brl'), 'COUNT(price_brl)'), 2)} AS avg_item_price_brl
    FROM ie GROUP BY seller_id"""

TABLES["seller_quality"] = f"""
    WITH shipped AS (
             SELECT ie.seller_id,
                    {rounded(over('SUM(actual_delivery_days)', 'COUNT(actual_delivery_days)'), 1)}
                        AS avg_delivery_days,
                    {rounded(over('COUNT(*) FILTER (is_on_time) * 100', 'COUNT(is_on_time)'), 2)}
                        AS on_time_delivery_rate_pct
             FROM ie JOIN done_orders d ON d.order_id = ie.order_id GROUP BY 1),
         rated AS (
             SELECT ie.seller_id,
                    {rounded(over('SUM(review_score)', 'COUNT(review_score)'), 2)}
                        AS avg_review_score,
                    COUNT(review_score) AS reviews_count
             FROM ie JOIN raw_reviews r ON r.order_id = ie.order_id GROUP BY 1),
         sold AS (SELECT seller_id, COUNT(DISTINCT order_id) AS total_orders FROM ie GROUP BY 1)
    SELECT sold.seller_id, total_orders, avg_delivery_days, on_time_delivery_rate_pct,
           avg_review_score, reviews_count
    FROM sold LEFT JOIN shipped ON shipped.seller_id = sold.seller_id
              LEFT JOIN rated ON rated.seller_id = sold.seller_id"""

TABLES["shops"] = """
    SELECT s.seller_id, s.seller_city, s.seller_state, total_orders, unique_products,
           categories_count, total_revenue_brl, avg_item_price_brl, avg_delivery_days,
           on_time_delivery_rate_pct, avg_review_score, reviews_count
    FROM raw_sellers s JOIN seller_totals t ON t.seller_id = s.seller_id
    LEFT JOIN seller_quality q ON q.seller_id = s.seller_id"""

TABLES["features"] = f"""
    WITH stats AS (
             SELECT customer_unique_id, MAX(total_payment_brl) AS hi, MIN(total_payment_brl) AS lo,
                    STDDEV_SAMP(total_payment_brl) AS dev,
                    CAST(SUM(actual_delivery_days) AS DOUBLE) / COUNT(actual_delivery_days) AS days,
                    COUNT(*) FILTER (is_on_time) AS good, COUNT(*) FILTER (NOT is_on_time) AS bad,
                    COUNT(*) FILTER (primary_payment_type = 'credit_card') AS card,
                    COUNT(*) FILTER (primary_payment_type = 'boleto') AS slip,
                    COUNT(*) FILTER (primary_payment_type = 'voucher') AS voucher,
                    COUNT(DISTINCT customer_state) AS states
             FROM done_orders GROUP BY 1),
         kinds AS (SELECT d.customer_unique_id, COUNT(DISTINCT s.primary_category) AS n
                   FROM done_orders d LEFT JOIN sales s ON s.order_id = d.order_id GROUP BY 1),
         stars AS (SELECT customer_unique_id,
                          CAST(SUM(review_score) AS DOUBLE) / COUNT(review_score) AS mean,
                          COUNT(review_score) AS n, COUNT(*) FILTER (review_score = 5) AS five,
                          COUNT(*) FILTER (review_score <= 2) AS low
                   FROM done_orders d LEFT JOIN raw_reviews r ON r.order_id = d.order_id GROUP BY 1)
    SELECT l.customer_unique_id, l.days_since_last_order,
           CAST(DATE '2001-08-02' - l.first_order_date AS INTEGER) AS days_since_first_order,
           l.total_orders,
           {over('l.total_orders', 'l.customer_age_days')} * 30 AS orders_per_month,
           {over('l.customer_age_days', 'l.total_orders - 1')} AS avg_days_between_orders,
           l.ltv_brl, l.avg_order_value_brl, hi AS max_order_value_brl, lo AS min_order_value_brl,
           COALESCE(dev, 0) AS stddev_order_value_brl, COALESCE(mean, 0) AS avg_review_score,
           COALESCE(stars.n, 0) AS reviews_count, COALESCE(five, 0) AS five_star_reviews,
           COALESCE(low, 0) AS low_score_reviews, COALESCE(days, 0) AS avg_delivery_days,
           COALESCE(good, 0) AS on_time_orders, COALESCE(bad, 0) AS late_orders,
           {over('COALESCE(good, 0)', 'l.total_orders')} AS on_time_rate,
           COALESCE(card, 0) AS credit_card_orders, COALESCE(slip, 0) AS boleto_orders,
           COALESCE(voucher, 0) AS voucher_orders, COALESCE(kinds.n, 0) AS unique_categories_count,
           COALESCE(states, 0) AS states_ordered_from,
           CAST(l.days_since_last_order > 365 AS INTEGER) AS is_churned,
           CAST(l.days_since_last_order > 180 AS INTEGER) AS is_at_risk
    FROM life l
    LEFT JOIN stats ON stats.customer_unique_id = l.customer_unique_id
    LEFT JOIN kinds ON kinds.customer_unique_id = l.customer_unique_id
    LEFT JOIN stars ON stars.customer_unique_id = l.customer_unique_id"""

# --- history -----------------------------------------------------------------


def rebuilt(check_cols: list[str], columns: list[str], source: str = "raw_marketplace") -> str:
    """Versions as islands of equal, uninterrupted runs."""
    changed = " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER w" for c in check_cols)
    firsts = ", ".join(f"arg_min(struct_pack(v := {c}), r).v AS {c}" for c in columns[1:])
    return f"""
    WITH calendar AS (SELECT run_ts, row_number() OVER (ORDER BY run_ts) AS r
                      FROM (SELECT DISTINCT run_ts FROM {source})),
         seen AS (SELECT o.*, name AS product_name, min_price_ars AS price_ars, r
                  FROM {source} o JOIN calendar c ON c.run_ts = o.run_ts),
         marked AS (SELECT *, CASE WHEN lag(r) OVER w IS NULL OR r - lag(r) OVER w > 1 OR {changed}
                              THEN 1 ELSE 0 END AS opens
                    FROM seen WINDOW w AS (PARTITION BY product_id ORDER BY r)),
         numbered AS (SELECT *, SUM(opens) OVER (PARTITION BY product_id ORDER BY r) AS version
                      FROM marked),
         islands AS (SELECT product_id, version, {firsts}, MIN(r) AS a, MAX(r) AS b
                     FROM numbered GROUP BY product_id, version)
    SELECT {', '.join('i.' + c for c in columns)},
           md5(product_id || '|' || strftime(s.run_ts, '%Y-%m-%d %H:%M:%S.%f')) AS dbt_scd_id,
           s.run_ts AS dbt_updated_at, s.run_ts AS dbt_valid_from, e.run_ts AS dbt_valid_to
    FROM islands i JOIN calendar s ON s.r = i.a LEFT JOIN calendar e ON e.r = i.b + 1"""


TABLES["hist"] = rebuilt(
    ["min_price_ars", "status", "category_id"],
    ["product_id", "category_id", "category_name", "product_name", "status", "price_ars",
     "currency", "ingested_at"])

TABLES["ph"] = f"""
    WITH v AS (SELECT *, row_number() OVER w AS k, lag(price_ars) OVER w AS was
               FROM hist WINDOW w AS (PARTITION BY product_id ORDER BY dbt_valid_from)),
         b AS (SELECT *, COALESCE(was, price_ars) AS base FROM v)
    SELECT product_id, category_id, category_name, product_name, status, price_ars, currency,
           CAST(dbt_valid_from AS DATE) AS valid_from, CAST(dbt_valid_to AS DATE) AS valid_to,
           dbt_valid_to IS NULL AS is_current,
           CAST(COALESCE(CAST(dbt_valid_to AS DATE), DATE '2024-01-31')
                - CAST(dbt_valid_from AS DATE) AS INTEGER) AS price_duration_days,
           CAST(k AS INTEGER) AS price_version, was AS prev_price_ars,
           {rounded('price_ars - base', 2)} AS price_delta_ars,
           {rounded(over('(price_ars - base) * 100', 'base'), 2)} AS price_change_pct,
           CASE WHEN was IS NULL THEN 'first_record' WHEN price_ars > was THEN 'increase'
                WHEN price_ars < was THEN 'decrease' ELSE 'unchanged' END AS price_change_direction
    FROM b"""

_GROWTH = rounded(over("(MAX(price_ars) - MIN(price_ars)) * 100", "MIN(price_ars)"), 1)

TABLES["ranking"] = f"""
    SELECT product_name, category_name, COUNT(*) AS price_versions,
           MIN(price_ars) AS start_price, MAX(price_ars) AS peak_price,
           {_GROWTH} AS total_growth_pct
    FROM ph GROUP BY 1, 2 HAVING COUNT(*) > 1"""

# --- calendar ----------------------------------------------------------------

_BR = "('01-01', '04-21', '05-01', '09-07', '10-12', '11-02', '11-15', '12-25')"
_AR = "('01-01', '03-24', '04-02', '05-01', '05-25', '06-20', '07-09', '12-08', '12-25')"

TABLES["cal"] = f"""
    SELECT d AS date_day, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
           CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
           strftime(d, '%b') AS month_name_short,
           CAST(strftime(d, '%U') AS INTEGER) AS week_of_year,
           CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
           strftime(d, '%a') AS day_name_short, CAST(day(d) AS INTEGER) AS day_of_month,
           CAST(dayofyear(d) AS INTEGER) AS day_of_year, dayofweek(d) IN (0, 6) AS is_weekend,
           day(d) = 1 AS is_first_day_of_month, day(d + 1) = 1 AS is_last_day_of_month,
           'Q' || CAST(quarter(d) AS VARCHAR) || ' ' || CAST(year(d) AS VARCHAR) AS quarter_label,
           strftime(d, '%b %Y') AS month_label,
           strftime(d, '%m-%d') IN {_BR} AS is_holiday_br,
           strftime(d, '%m-%d') IN {_AR} AS is_holiday_ar,
           dayofweek(d) NOT IN (0, 6) AND strftime(d, '%m-%d') NOT IN {_BR} AS is_business_day_br
    FROM (SELECT CAST(unnest(generate_series(MIN(o_orderdate), MAX(o_orderdate),
                                             INTERVAL 1 DAY)) AS DATE) AS d FROM orders)"""

# --- replies of the marketplace --------------------------------------------------

TABLES["highlights"] = """
    SELECT 'C' || CAST(p_size % 25 AS VARCHAR) AS category_id,
           CAST(p_partkey AS VARCHAR) AS product_id, CAST(p_partkey // 7 AS INTEGER) AS position
    FROM part"""

TABLES["details"] = """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name,
           CASE WHEN p_size > 40 THEN 'paused' ELSE 'active' END AS status, p_brand AS domain_id
    FROM part WHERE p_brand <> 'Brand#13'"""

TABLES["lowest"] = """
    SELECT CAST(l_partkey AS VARCHAR) AS product_id, MIN(l_extendedprice) AS min_price_ars
    FROM lineitem WHERE l_returnflag = 'A' AND l_extendedprice <> 0 GROUP BY 1"""

TABLES["top_highlights"] = """
    SELECT * FROM highlights
    QUALIFY row_number() OVER (PARTITION BY category_id ORDER BY position, product_id) <= 10"""

TABLES["first_categories"] = """
    SELECT 'C' || CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, 100 - n_nationkey AS position
    FROM nation ORDER BY position, id LIMIT 5"""

# --- volumes -------------------------------------------------------------------

TABLES["per_day"] = "SELECT order_date, COUNT(*) AS n FROM sales GROUP BY 1"


def low_days(source: str) -> str:
    """Days below seven tenths of the mean of the seven rows before, in whole numbers."""
    return f"""
    SELECT order_date FROM (
        SELECT order_date, n, SUM(n) OVER w AS s, COUNT(n) OVER w AS k FROM ({source})
        WINDOW w AS (ORDER BY order_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
    WHERE n * 10 * k < s * 7"""


_FILLED = """SELECT date_day AS order_date, COALESCE(n, 0) AS n
             FROM cal LEFT JOIN per_day ON per_day.order_date = cal.date_day"""


def low_days_of(source: str, day: str | None = None) -> str:
    where = f" WHERE order_date = DATE '{day}'" if day else ""
    return f"SELECT order_date FROM ({low_days(source)}){where}"


# --- statements ------------------------------------------------------------------

STATEMENTS: dict[str, str] = {}

STATEMENTS["s1_csv_load"] = "SELECT * FROM raw_orders"
STATEMENTS["s1_csv_free_text"] = """
    SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS review_id,
           CAST(conv_id AS VARCHAR) AS order_id, turn AS review_score,
           NULLIF(role, 'system') AS review_comment_title, text AS review_comment_message,
           TIMESTAMP '2024-01-31 00:00:00' AS review_creation_date,
           CAST(NULL AS TIMESTAMP) AS review_answer_timestamp
    FROM conversations"""
STATEMENTS["s1_csv_ranges"] = r"""
    SELECT CAST(doc_id AS VARCHAR) AS review_id, source AS order_id, CAST(n_chars AS BIGINT) AS review_score,
           lang AS review_comment_title, CAST(length(t) AS INTEGER) AS chars, sha256(t) AS digest
    FROM (SELECT *, NULLIF(text, '') AS t FROM documents)"""
STATEMENTS["s2_jsonl_load"] = "SELECT * EXCLUDE (run_ts) FROM raw_marketplace"
STATEMENTS["s3_jsonl_sink"] = """
    SELECT conv_id, turn, NULLIF(role, 'system') AS role, text, TRUE AS role_written,
           FALSE AS letters_escaped
    FROM conversations"""
STATEMENTS["s4_read_drop"] = """
    WITH drops AS (SELECT seller_id, seller_zip_code_prefix,
                          seller_city || '@' || CAST(i AS VARCHAR) AS seller_city, seller_state,
                          CAST(DATE '2024-01-29' + CAST(i AS INTEGER) AS DATE) AS load_date, i
                   FROM raw_sellers, range(3) d(i))
    SELECT * EXCLUDE (i), 'together' AS how FROM drops
    UNION ALL SELECT * EXCLUDE (i), 'alone' FROM drops WHERE i = 1"""
STATEMENTS["s5_land_drop"] = """
    SELECT step, outcome, customer_id, customer_unique_id, customer_zip_code_prefix,
           CASE step WHEN 'forced' THEN lower(customer_city) ELSE customer_city END
               AS customer_city, customer_state
    FROM raw_customers, (VALUES ('first', 'success'), ('again', 'skipped'),
                                ('forced', 'success')) v(step, outcome)"""

_RAW_NAMES = ["orders", "order_items", "order_payments", "customers", "sellers", "products",
              "reviews", "product_categories"]
STATEMENTS["s6_source_gate"] = " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", 'ok' AS verdict, COUNT(*) AS \"rows\" FROM raw_{n}"
    for n in _RAW_NAMES) + " UNION ALL SELECT 'returns', 'missing', NULL"
STATEMENTS["s7_load_all"] = " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", 'success' AS status, COUNT(*) AS \"rows\", FALSE AS has_reason "
    f"FROM raw_{n}" for n in _RAW_NAMES) + " UNION ALL SELECT 'returns', 'error', NULL, TRUE"
STATEMENTS["s6_empty_source"] = """
    SELECT 'sellers' AS "table", 'success' AS status, COUNT(*) AS "rows" FROM raw_sellers
    UNION ALL SELECT 'customers', 'error', NULL
    UNION ALL SELECT 'orders', 'error', NULL"""
STATEMENTS["s7_failed_load"] = """
    SELECT seller_id, seller_city, seller_state, 'error' AS second_load FROM raw_sellers"""
STATEMENTS["s7_quoted_breaks"] = """
    SELECT seller_id, seller_city || chr(10) || 'south' AS seller_city, seller_state FROM raw_sellers"""
STATEMENTS["s4_dated_texts"] = """
    SELECT seller_id, CAST(DATE '2024-01-30' + CAST(i AS INTEGER) AS DATE) AS load_date
    FROM raw_sellers, range(2) d(i)"""
STATEMENTS["s8_write_disposition"] = """
    SELECT seller_id, seller_city, seller_state, CAST(2 AS BIGINT) AS copies,
           TRUE AS refused_when_full
    FROM raw_sellers"""
STATEMENTS["s8_table_versions"] = """
    SELECT seller_state, version, CAST(SUM(n) AS BIGINT) AS sellers
    FROM (SELECT seller_state, COUNT(*) AS n FROM raw_sellers GROUP BY 1),
         (VALUES (1, 'all'), (2, 'all'), (2, 'some'), (3, 'some')) v(version, part)
    WHERE part = 'all' OR seller_state <> 'ASIA' GROUP BY 1, 2"""
STATEMENTS["s9_empty_batch"] = """
    SELECT product_id, product_category_name, TRUE AS first_written, FALSE AS empty_written
    FROM raw_products"""
STATEMENTS["s10_table_registry"] = """
    SELECT customer_state, order_status, COUNT(*) AS order_count
    FROM raw_orders o JOIN raw_customers c ON c.customer_id = o.customer_id GROUP BY 1, 2"""
STATEMENTS["s11_materialize"] = f"""
    SELECT order_id, {money('payment_value')} AS total_payment_brl, COUNT(*) AS payment_count,
           MAX(payment_type) AS primary_payment_type
    FROM raw_order_payments GROUP BY order_id"""
STATEMENTS["s11_pinned_reader"] = f"""
    WITH totals AS ({STATEMENTS["s11_materialize"]})
    SELECT *, 'first' AS reader FROM totals
    UNION ALL SELECT *, 'next' FROM totals WHERE payment_count > 1"""
STATEMENTS["s12_audit_append"] = """
    SELECT CASE WHEN len(tables_referenced) = 0 THEN 'anonymous'
                ELSE COALESCE(user_id, 'anonymous') END AS user_id,
           question, generated_sql, array_to_string(tables_referenced, ',') AS tables_referenced,
           CASE WHEN len(tables_referenced) = 0 THEN 0 ELSE COALESCE(tokens_used, 0) END
               AS tokens_used, created_at
    FROM audit_log"""
STATEMENTS["s13_schema_drift"] = """
    SELECT 'order_id' AS "column", 'ok' AS status, CAST(0 AS BIGINT) AS bad_rows
    UNION ALL SELECT 'customer_id', CASE WHEN n > 0 THEN 'bad_values' ELSE 'ok' END, n
              FROM (SELECT COUNT(*) AS n FROM orders WHERE o_custkey = 7)
    UNION ALL SELECT c, 'ok', 0 FROM (VALUES ('order_status'), ('order_purchase_timestamp'),
              ('order_delivered_carrier_date'), ('order_delivered_customer_date')) v(c)
    UNION ALL SELECT 'order_approved_at', 'missing', NULL
    UNION ALL SELECT 'order_estimated_delivery_date',
                     CASE WHEN n > 0 THEN 'bad_values' ELSE 'ok' END, n
              FROM (SELECT COUNT(*) AS n FROM orders WHERE o_orderstatus = 'P')
    UNION ALL SELECT 'sales_channel', 'extra', NULL"""

STATEMENTS["r1_first_categories"] = "SELECT * FROM first_categories"
STATEMENTS["r2_top_highlights"] = "SELECT * FROM top_highlights"
STATEMENTS["r3_min_listing_price"] = """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, min_price_ars
    FROM part LEFT JOIN lowest ON lowest.product_id = CAST(p_partkey AS VARCHAR)"""
STATEMENTS["r3_nested_listings"] = """
    SELECT CAST(l_partkey AS VARCHAR) AS product_id, COUNT(*) AS listings,
           MIN(CASE WHEN l_returnflag = 'A' AND l_extendedprice <> 0 THEN l_extendedprice END)
               AS min_price_ars
    FROM lineitem GROUP BY 1"""
STATEMENTS["r4_marketplace_products"] = """
    SELECT d.product_id, h.category_id, c.name AS category_name, d.name, d.status, d.domain_id,
           min_price_ars, 'ARS' AS currency, TIMESTAMP '2024-01-31 00:00:00' AS ingested_at
    FROM first_categories c JOIN top_highlights h ON h.category_id = c.id
    JOIN details d ON d.product_id = h.product_id
    LEFT JOIN lowest ON lowest.product_id = h.product_id"""
STATEMENTS["r5_products_with_detail"] = """
    SELECT h.*, d.name, d.status, d.domain_id
    FROM highlights h JOIN details d ON d.product_id = h.product_id"""

STATEMENTS["p1_stg_orders"] = """
    SELECT order_id, customer_id, order_status, order_purchase_timestamp AS purchased_at,
           order_approved_at AS approved_at,
           order_delivered_carrier_date AS delivered_to_carrier_at,
           order_delivered_customer_date AS delivered_to_customer_at,
           order_estimated_delivery_date AS estimated_delivery_at
    FROM raw_orders"""
STATEMENTS["p2_stg_customers"] = """
    SELECT customer_id, customer_unique_id,
           left(customer_zip_code_prefix, 3) || '**' AS zip_code_masked,
           customer_zip_code_prefix AS zip_code_raw, customer_city AS city, customer_state AS state
    FROM raw_customers"""
STATEMENTS["p3_stg_order_items"] = """
    SELECT order_id, order_item_id, product_id, seller_id,
           shipping_limit_date AS shipping_limit_at, price AS price_brl,
           freight_value AS freight_brl, price + freight_value AS total_brl
    FROM raw_order_items"""
STATEMENTS["p4_stg_order_payments"] = """
    SELECT order_id, payment_sequential, payment_type, payment_installments AS installments,
           payment_value AS payment_brl
    FROM raw_order_payments"""
STATEMENTS["p5_stg_products"] = """
    SELECT product_id, product_category_name AS category_name_pt,
           product_name_lenght AS name_length, product_description_lenght AS description_length,
           product_photos_qty AS photos_qty, product_weight_g AS weight_g,
           product_length_cm AS length_cm, product_height_cm AS height_cm,
           product_width_cm AS width_cm
    FROM raw_products"""
STATEMENTS["p6_stg_product_categories"] = """
    SELECT product_category_name AS category_name_pt,
           product_category_name_english AS category_name_en
    FROM raw_product_categories"""
STATEMENTS["p7_stg_reviews"] = """
    SELECT review_id, order_id, review_score AS score, review_comment_title AS comment_title,
           review_comment_message AS comment_message, review_creation_date AS created_at,
           review_answer_timestamp AS answered_at
    FROM raw_reviews"""
STATEMENTS["p8_stg_sellers"] = """
    SELECT seller_id, seller_zip_code_prefix AS zip_code, seller_city AS city,
           seller_state AS state
    FROM raw_sellers"""
STATEMENTS["p9_stg_marketplace_products"] = """
    SELECT * RENAME (name AS product_name, min_price_ars AS price_ars) FROM raw_marketplace"""

STATEMENTS["w1_delivered_orders"] = f"""
    SELECT * FROM ({STATEMENTS['p1_stg_orders']}) WHERE order_status = 'delivered'"""
STATEMENTS["w7_sales_in_range"] = """
    SELECT order_id, order_date, primary_category, total_payment_brl FROM sales
    WHERE order_date BETWEEN DATE '1997-02-10' AND DATE '1997-04-20'"""
STATEMENTS["a1_payments_per_order"] = STATEMENTS["s11_materialize"]
STATEMENTS["a3_items_per_order"] = "SELECT * FROM item_sums"
STATEMENTS["a4_reviews_per_order"] = "SELECT * FROM review_sums"
STATEMENTS["a8_reviews_per_customer"] = "SELECT * FROM person_reviews"
STATEMENTS["a9_seller_sales"] = "SELECT * FROM seller_totals"
STATEMENTS["a11_seller_service"] = "SELECT * FROM seller_quality"
STATEMENTS["a16_daily_volumes"] = """
    SELECT order_date, n AS order_count, CAST(SUM(n) OVER w AS DOUBLE) / COUNT(n) OVER w
               AS avg_last_7_days
    FROM per_day WINDOW w AS (ORDER BY order_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"""
STATEMENTS["n1_global_ntile"] = """
    SELECT order_id, actual_delivery_days, payment_count AS payments,
           CAST(NTILE(7) OVER (ORDER BY actual_delivery_days DESC NULLS LAST, order_id)
                AS INTEGER) AS slowest,
           CAST(NTILE(7) OVER (ORDER BY payment_count NULLS FIRST, order_id) AS INTEGER) AS fewest
    FROM oe"""
STATEMENTS["n1_n3_rfm_scores"] = "SELECT customer_unique_id, r_score, f_score, m_score FROM scores"
STATEMENTS["t7_row_cap"] = """
    SELECT order_id, order_date, total_payment_brl FROM oe
    ORDER BY total_payment_brl DESC, order_id LIMIT 20"""

STATEMENTS["h1_snapshot_run"] = "SELECT * FROM hist"
STATEMENTS["h2_snap_products"] = "SELECT * FROM hist"
STATEMENTS["h3_snap_sellers"] = """
    WITH s AS (SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, city, state, s_acctbal AS b
               FROM supplier JOIN places ON n_nationkey = s_nationkey),
         kept AS (SELECT * FROM s WHERE b BETWEEN 0 AND 5000),
         moved AS (SELECT * FROM s WHERE b > 5000),
         gone AS (SELECT * FROM s WHERE b < 0),
         versions AS (
             SELECT seller_id, city, state, 1 AS a, NULL AS z FROM kept
             UNION ALL SELECT seller_id, city, state, 1, 2 FROM moved
             UNION ALL SELECT seller_id, 'New ' || city, CASE WHEN b <= 9000 THEN state END, 2, 3
                       FROM moved
             UNION ALL SELECT seller_id, city, state, 3, NULL FROM moved
             UNION ALL SELECT seller_id, city, state, 1, 2 FROM gone
             UNION ALL SELECT seller_id, city, state, 3, NULL FROM gone)
    SELECT seller_id, city, state,
           md5(seller_id || '|2024-01-0' || CAST(a AS VARCHAR) || ' 00:00:00.000000') AS dbt_scd_id,
           make_timestamp(2024, 1, a, 0, 0, 0) AS dbt_updated_at,
           make_timestamp(2024, 1, a, 0, 0, 0) AS dbt_valid_from,
           make_timestamp(2024, 1, z, 0, 0, 0) AS dbt_valid_to
    FROM versions"""
STATEMENTS["h3_merged_runs"] = STATEMENTS["h3_snap_sellers"]
STATEMENTS["h4_history_rebuild"] = rebuilt(
    ["min_price_ars", "status"], ["product_id", "price_ars", "status"])
STATEMENTS["h5_valid_at"] = """
    SELECT m AS moment, product_id, price_ars, status, dbt_valid_from, dbt_valid_to
    FROM hist, (VALUES ('then'), ('now')) v(m)
    WHERE CASE m WHEN 'now' THEN dbt_valid_to IS NULL
          ELSE dbt_valid_from <= TIMESTAMP '2024-01-15 12:00:00'
               AND COALESCE(dbt_valid_to > TIMESTAMP '2024-01-15 12:00:00', TRUE) END"""

STATEMENTS["m1_orders_enriched"] = "SELECT * FROM oe"
STATEMENTS["m2_order_items_enriched"] = "SELECT * FROM ie"
STATEMENTS["m3_customers_lifetime"] = "SELECT * FROM life"
STATEMENTS["m4_mart_sales"] = "SELECT * FROM sales"
STATEMENTS["j3_bucketed_sales"] = STATEMENTS["m4_mart_sales"]
STATEMENTS["m5_mart_customers"] = "SELECT * FROM people"
STATEMENTS["m6_mart_cohorts"] = "SELECT * FROM cohorts"
STATEMENTS["m7_mart_sellers"] = "SELECT * FROM shops"
STATEMENTS["m8_mart_customer_features"] = """
    SELECT * REPLACE (CAST(ROUND(CAST(stddev_order_value_brl AS DECIMAL(28,8)), 4) AS DOUBLE)
                      AS stddev_order_value_brl)
    FROM features"""
STATEMENTS["m9_mart_price_history"] = "SELECT * FROM ph"
STATEMENTS["m10_dim_date"] = """
    SELECT cal.*, COALESCE(n, 0) AS order_count
    FROM cal LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n
                        FROM orders GROUP BY 1) o ON o.d = cal.date_day"""
STATEMENTS["m11_sales_by_calendar"] = f"""
    SELECT quarter_label, is_weekend, is_holiday_br, is_business_day_br, COUNT(*) AS order_count,
           {money('total_payment_brl')} AS revenue_brl
    FROM sales JOIN cal ON cal.date_day = sales.order_date GROUP BY 1, 2, 3, 4"""

STATEMENTS["q1_not_null"] = """
    SELECT product_id FROM raw_products WHERE product_category_name IS NULL"""
STATEMENTS["q2_unique"] = """
    SELECT order_id, COUNT(*) AS n_records FROM raw_order_items
    WHERE order_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1"""
STATEMENTS["q3_accepted_values"] = """
    SELECT category_name_en, COUNT(*) AS n_records FROM ie
    WHERE category_name_en NOT IN ('economy', 'large', 'medium', 'small') GROUP BY 1"""
STATEMENTS["q4_delivery_after_purchase"] = """
    SELECT order_id FROM sales WHERE delivered_to_customer_at < purchased_at + to_days(12)"""
STATEMENTS["q5_revenue_non_negative"] = """
    SELECT order_id FROM sales WHERE total_payment_brl - 100000 < 0"""
STATEMENTS["q6_retention_rate_valid"] = f"""
    SELECT * FROM (SELECT cohort_month, months_since_first_order,
                          {rounded('(retention_rate_pct - 3) * 2', 2)} AS retention_rate_pct
                   FROM cohorts)
    WHERE retention_rate_pct < 0 OR retention_rate_pct > 100"""


def _overlaps(source: str, kind: str) -> str:
    """Pairs of versions of a key that are valid at the same time, as a self-join."""
    return f"""
    SELECT DISTINCT x.product_id, '{kind}' AS kind
    FROM {source} x JOIN {source} y ON y.product_id = x.product_id
         AND y.dbt_scd_id <> x.dbt_scd_id
         AND x.dbt_valid_from < COALESCE(y.dbt_valid_to, TIMESTAMP '9999-12-31 00:00:00')
         AND y.dbt_valid_from < COALESCE(x.dbt_valid_to, TIMESTAMP '9999-12-31 00:00:00')"""


TABLES["late_hist"] = """
    SELECT * REPLACE (CASE WHEN price_ars > 200 THEN dbt_valid_to + to_days(2)
                           ELSE dbt_valid_to END AS dbt_valid_to) FROM hist"""
STATEMENTS["q7_no_overlapping_periods"] = (
    _overlaps("hist", "clean") + " UNION ALL " + _overlaps("late_hist", "late"))
STATEMENTS["q7_overlapping_pairs"] = """
    SELECT x.product_id, x.dbt_scd_id AS first_id, y.dbt_scd_id AS second_id,
           GREATEST(x.dbt_valid_from, y.dbt_valid_from) AS overlap_from,
           LEAST(COALESCE(x.dbt_valid_to, TIMESTAMP '9999-12-31 00:00:00'),
                 COALESCE(y.dbt_valid_to, TIMESTAMP '9999-12-31 00:00:00')) AS overlap_to
    FROM late_hist x JOIN late_hist y ON y.product_id = x.product_id
         AND x.dbt_scd_id < y.dbt_scd_id
         AND x.dbt_valid_from < COALESCE(y.dbt_valid_to, TIMESTAMP '9999-12-31 00:00:00')
         AND y.dbt_valid_from < COALESCE(x.dbt_valid_to, TIMESTAMP '9999-12-31 00:00:00')"""
STATEMENTS["q7_unique_versions"] = """
    SELECT product_id, date_trunc('week', dbt_valid_from)::TIMESTAMP AS dbt_valid_from,
           COUNT(*) AS n_records
    FROM hist GROUP BY 1, 2 HAVING COUNT(*) > 1"""
STATEMENTS["q8_volume_anomaly"] = f"""
    SELECT order_date, 'all days' AS form FROM ({low_days_of('SELECT * FROM per_day')})
    UNION ALL SELECT order_date, 'one day'
              FROM ({low_days_of('SELECT * FROM per_day', '1997-06-01')})
    UNION ALL SELECT order_date, 'with empty days' FROM ({low_days_of(_FILLED)})"""
STATEMENTS["q9_relationships"] = """
    SELECT order_id AS value, COUNT(*) AS n_records, 'reviews' AS child FROM raw_reviews
    WHERE order_id NOT IN (SELECT order_id FROM raw_orders WHERE order_status = 'delivered')
    GROUP BY 1
    UNION ALL
    SELECT product_id, COUNT(*), 'items' FROM raw_order_items
    WHERE product_id NOT IN (SELECT product_id FROM raw_products
                             WHERE product_category_name IS NOT NULL)
    GROUP BY 1"""


def _suite(rules, names: dict[str, str]) -> str:
    """One row per declared check, each counted by its own subquery."""
    parts = []

    def add(check: str, table: str, violations: str) -> None:
        parts.append(f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", "
                     f"(SELECT COUNT(*) FROM ({violations})) AS failures")

    for table, column, unique, accepted in rules:
        source = names[table]
        add(f"not_null_{column}", table, f"SELECT 1 FROM {source} WHERE {column} IS NULL")
        if unique:
            add(f"unique_{column}", table,
                f"SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
                f"GROUP BY 1 HAVING COUNT(*) > 1")
        if accepted:
            add(f"accepted_values_{column}", table,
                f"SELECT DISTINCT {column} FROM {source} WHERE {column} NOT IN {accepted!r}")
    return " UNION ALL ".join(parts)


def _with_status(report: str) -> str:
    return f"SELECT *, CASE failures WHEN 0 THEN 'pass' ELSE 'fail' END AS status FROM ({report})"


_SOURCE_NAMES = {n: f"raw_{n}" for n in _RAW_NAMES} | {"marketplace_products": "raw_marketplace"}
_MART_NAMES = {"mart_sales": "sales", "mart_customers": "people", "mart_cohorts": "cohorts",
               "mart_sellers": "shops", "mart_price_history": "ph", "dim_date": "cal",
               "mart_customer_features": "features"}
STATEMENTS["q10_source_suite"] = _with_status(_suite(SOURCE_RULES, _SOURCE_NAMES))
STATEMENTS["q10_mart_suite"] = _with_status(f"""
    {_suite(MART_RULES, _MART_NAMES)}
    UNION ALL SELECT 'delivery_after_purchase', 'mart_sales',
        (SELECT COUNT(*) FROM sales WHERE delivered_to_customer_at < purchased_at)
    UNION ALL SELECT 'revenue_non_negative', 'mart_sales',
        (SELECT COUNT(*) FROM sales WHERE total_payment_brl < 0)
    UNION ALL SELECT 'retention_rate_valid', 'mart_cohorts',
        (SELECT COUNT(*) FROM cohorts WHERE retention_rate_pct NOT BETWEEN 0 AND 100)
    UNION ALL SELECT 'scd_no_overlapping_periods', 'snap_products',
        (SELECT COUNT(*) FROM ({_overlaps('hist', 'clean')}))
    UNION ALL SELECT 'scd_unique_versions', 'snap_products',
        (SELECT COUNT(*) FROM (SELECT 1 FROM hist GROUP BY product_id, dbt_valid_from
                               HAVING COUNT(*) > 1))
    UNION ALL SELECT 'volume_anomaly_orders', 'mart_sales',
        (SELECT COUNT(*) FROM ({low_days_of('SELECT * FROM per_day', '1997-06-01')}))""")

_AOV = over(money("total_payment_brl"), "COUNT(order_id)")
STATEMENTS["k1_gross_revenue"] = f"""
    SELECT customer_state, {money('total_payment_brl')} AS gross_revenue_brl FROM sales GROUP BY 1"""
STATEMENTS["k2_order_count"] = """
    SELECT primary_category, is_on_time, COUNT(order_id) AS order_count FROM sales GROUP BY 1, 2"""
STATEMENTS["k3_avg_order_value"] = f"""
    SELECT primary_payment_type, {_AOV} AS avg_order_value_brl FROM sales GROUP BY 1"""
STATEMENTS["k4_avg_delivery_days"] = f"""
    SELECT customer_city,
           {over('SUM(actual_delivery_days)', 'COUNT(actual_delivery_days)')} AS avg_delivery_days
    FROM sales WHERE primary_category IS NOT NULL GROUP BY 1"""
STATEMENTS["k5_on_time_delivery_rate"] = f"""
    SELECT customer_state, {over('COUNT(*) FILTER (is_on_time) * 100', 'COUNT(is_on_time)')}
               AS on_time_delivery_rate
    FROM sales GROUP BY 1"""
STATEMENTS["k6_monthly_retention_rate"] = f"""
    SELECT months_since_first_order,
           {over('SUM(retained_customers) * 100', 'SUM(cohort_size)')} AS monthly_retention_rate
    FROM cohorts GROUP BY 1"""
STATEMENTS["k7_customer_ltv"] = f"""
    SELECT rfm_segment, {over(money('ltv_brl'), 'COUNT(ltv_brl)')} AS customer_ltv_brl
    FROM people GROUP BY 1"""
STATEMENTS["k8_active_customers"] = """
    SELECT COUNT(*) AS active_customers, d AS as_of
    FROM life, (VALUES (DATE '2001-08-02'), (DATE '2000-08-02')) v(d)
    WHERE last_order_date >= d - 365 GROUP BY d"""
STATEMENTS["k1_revenue_by_month"] = f"""
    SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month,
           {money('total_payment_brl')} AS gross_revenue_brl, COUNT(order_id) AS order_count,
           {_AOV} AS avg_order_value_brl
    FROM sales GROUP BY 1"""

STATEMENTS["d1_price_listing"] = """
    SELECT product_name, category_name, price_ars, prev_price_ars, price_delta_ars,
           price_change_pct, price_change_direction, valid_from, valid_to, is_current,
           price_version
    FROM ph"""
STATEMENTS["d2_price_ranking"] = "SELECT * FROM ranking"
STATEMENTS["d3_top_growth"] = """
    SELECT * FROM ranking
    ORDER BY total_growth_pct DESC NULLS LAST, product_name, category_name NULLS FIRST LIMIT 10"""
STATEMENTS["d4_price_kpis"] = """
    SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT product_name FROM ph)) AS products_tracked,
           (SELECT COUNT(*) FROM ph WHERE price_version > 1) AS price_changes,
           (SELECT COALESCE(MAX(total_growth_pct), 0) FROM ranking) AS max_growth_pct"""
STATEMENTS["d5_product_names"] = """
    SELECT DISTINCT product_name, 'all' AS list FROM ph
    UNION ALL SELECT DISTINCT product_name, 'changed' FROM ranking"""
STATEMENTS["d6_product_detail"] = """
    SELECT price_version, valid_from, price_ars, price_delta_ars, price_change_pct,
           price_change_direction, is_current,
           strftime(valid_from, '%d.%m') || ' (v' || CAST(price_version AS VARCHAR) || ')' AS label
    FROM ph WHERE product_name = (SELECT MIN(product_name) FROM ph)"""
STATEMENTS["d7_category_volatility"] = f"""
    SELECT category_name, COUNT(product_name) AS products,
           {over('CAST(SUM(CAST(total_growth_pct AS DECIMAL(18,1))) AS DOUBLE)',
                 'COUNT(total_growth_pct)')} AS avg_growth,
           MAX(total_growth_pct) AS max_growth
    FROM ranking WHERE category_name IS NOT NULL GROUP BY 1"""
STATEMENTS["d8_price_gallery"] = f"""
    SELECT product_id, product_name, category_name, COUNT(*) AS price_versions,
           MIN(price_ars) AS start_price, MAX(price_ars) AS peak_price,
           MAX(price_ars) FILTER (is_current) AS current_price, {_GROWTH} AS growth_pct,
           CASE WHEN length(product_name) <= 50 THEN product_name
                ELSE left(product_name, 50) || '...' END AS short_name,
           MAX(price_ars) - MIN(price_ars) AS price_rise
    FROM ph GROUP BY 1, 2, 3 HAVING COUNT(*) > 1
    ORDER BY growth_pct DESC NULLS LAST, product_id LIMIT 30"""
STATEMENTS["d9_product_history"] = """
    SELECT price_version, valid_from, price_ars, price_delta_ars, price_change_pct,
           price_change_direction
    FROM ph WHERE product_id = (SELECT product_id FROM ph
                                ORDER BY price_version DESC, product_id LIMIT 1)"""
STATEMENTS["d10_price_drops"] = f"""
    SELECT product_id, product_name, category_name, COUNT(*) AS price_versions,
           MAX(price_ars) AS peak_price, MIN(price_ars) AS current_price,
           {rounded(over('(MIN(price_ars) - MAX(price_ars)) * 100', 'MAX(price_ars)'), 1)}
               AS drop_pct,
           left(product_name, 70) AS short_name
    FROM ph GROUP BY 1, 2, 3 HAVING COUNT(*) > 1 AND MIN(price_ars) < MAX(price_ars)"""
STATEMENTS["d10_directional_drops"] = f"""
    WITH g AS (SELECT product_id, product_name, category_name, COUNT(*) AS price_versions,
                      MAX(price_ars) AS peak_price, MAX(price_version) AS k
               FROM ph GROUP BY 1, 2, 3)
    SELECT g.product_id, g.product_name, g.category_name, price_versions, peak_price,
           ph.price_ars AS current_price,
           {rounded(over('(ph.price_ars - peak_price) * 100', 'peak_price'), 1)} AS drop_pct,
           left(g.product_name, 70) AS short_name
    FROM g JOIN ph ON ph.product_id = g.product_id AND ph.price_version = g.k
    WHERE price_versions > 1 AND ph.price_ars < peak_price"""
STATEMENTS["d11_price_waterfall"] = """
    SELECT product_id, price_version, 'Start' AS label, 'absolute' AS measure, price_ars AS value
    FROM ph WHERE price_version = 1
    UNION ALL
    SELECT product_id, price_version, 'v' || CAST(price_version AS VARCHAR), 'relative',
           price_delta_ars
    FROM ph WHERE price_version > 1"""

_STORED = """order_id, order_date, CAST(date_trunc('month', order_date) AS DATE) AS order_month,
             customer_state, primary_category, items_value_brl"""
STATEMENTS["i1_partitioned_mart"] = f"""
    SELECT {_STORED}, total_payment_brl, review_score FROM sales"""
STATEMENTS["i2_clustered_files"] = """
    SELECT order_id, order_date, CAST(date_trunc('month', order_date) AS DATE) AS order_month,
           customer_state, primary_category, total_payment_brl
    FROM sales WHERE customer_state = 'ASIA' AND year(order_date) = 1995"""
STATEMENTS["i3_incremental_refresh"] = STATEMENTS["i1_partitioned_mart"]
STATEMENTS["i4_backfill"] = f"""
    SELECT {_STORED},
           CASE WHEN order_date BETWEEN DATE '1997-02-01' AND DATE '1997-04-30'
                THEN total_payment_brl
                ELSE CAST(CAST(total_payment_brl AS DECIMAL(18,2)) * 10 AS DOUBLE) END
               AS total_payment_brl,
           review_score
    FROM sales"""

STATEMENTS["i3_versioned_refresh"] = STATEMENTS["i1_partitioned_mart"]
_PER_MONTH = """SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month, COUNT(*) AS orders,
           SUM(CAST(total_payment_brl AS DECIMAL(28,4))) AS total FROM sales GROUP BY 1"""
STATEMENTS["i4_versioned_backfill"] = f"""
    SELECT order_month, orders, CAST(total * 10 AS DOUBLE) AS total_payment_brl, 'before' AS state
    FROM ({_PER_MONTH})
    UNION ALL
    SELECT order_month, orders, CAST(total * CASE
               WHEN order_month BETWEEN DATE '1997-02-01' AND DATE '1997-04-01' THEN 1 ELSE 10 END AS DOUBLE), 'after'
    FROM ({_PER_MONTH})"""

STATEMENTS["i3_filtered_range"] = """
    SELECT order_id, order_date, items_value_brl, total_payment_brl, review_count FROM sales
    WHERE order_date BETWEEN DATE '1995-01-01' AND DATE '1995-06-30'"""
STATEMENTS["i3_late_changes"] = STATEMENTS["i1_partitioned_mart"]
STATEMENTS["i3_changed_orders"] = """
    WITH changed AS (
        SELECT order_id FROM raw_reviews WHERE CAST(order_id AS BIGINT) % 641 = 3
        UNION SELECT order_id FROM raw_order_payments
              WHERE CAST(order_id AS BIGINT) % 1009 = 6 AND payment_value IS DISTINCT FROM 1
        UNION SELECT order_id FROM raw_orders WHERE order_id = '7')
    SELECT c.order_id, CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS order_month
    FROM changed c LEFT JOIN raw_orders o ON o.order_id = c.order_id"""

STATEMENTS["m5_merged_state"] = STATEMENTS["m5_mart_customers"]
STATEMENTS["m8_merged_state"] = STATEMENTS["m8_mart_customer_features"]
STATEMENTS["m3_day_delta"] = STATEMENTS["m3_customers_lifetime"]

STATEMENTS["i3_emptied_last_month"] = f"""
    SELECT {_STORED}, total_payment_brl, review_score FROM sales WHERE order_date < DATE '2001-06-01'"""
STATEMENTS["i4_emptied_month"] = f"""
    SELECT {_STORED}, total_payment_brl, review_score FROM sales
    WHERE order_date NOT BETWEEN DATE '1997-03-01' AND DATE '1997-03-31'"""

# Word characters of every script; RE2's own word boundary knows only ASCII.
_W = r"[\pL\pN_]"
_NOT_W = r"[^\pL\pN_]"
_EMAIL = (
    rf"(?i)(?:(?:^|{_NOT_W})[a-z0-9_]|{_W}[.%+-])[a-z0-9._%+-]*@[a-z0-9.-]+\."
    rf"[a-z|]+(?:[a-z](?:$|{_NOT_W})|\|{_W})")
_PHONE = rf"(?:^|{_NOT_W})\p{{Nd}}{{3}}[-.]?\p{{Nd}}{{3}}[-.]?\p{{Nd}}{{4}}(?:$|{_NOT_W})"
_HAS_EMAIL = f"regexp_matches(text, '{_EMAIL}')"
_HAS_PHONE = f"regexp_matches(text, '{_PHONE}')"
STATEMENTS["g1_pii_documents"] = f"""
    SELECT doc_id, {_HAS_EMAIL} AS has_email, {_HAS_PHONE} AS has_phone,
           {_HAS_EMAIL} OR {_HAS_PHONE} AS has_pii
    FROM documents"""
STATEMENTS["g1_pii_questions"] = f"""
    SELECT {_HAS_EMAIL} AS has_email, {_HAS_PHONE} AS has_phone, COUNT(*) AS questions
    FROM conversations GROUP BY 1, 2"""

_KEYWORD = "CASE " + " ".join(
    f"WHEN regexp_matches(upper(sql), '\\b{w}\\b') THEN '{w}'" for w in FORBIDDEN_KEYWORDS) + " END"
STATEMENTS["g2_sql_guard"] = f"""
    WITH found AS (
        SELECT event_id, sql, {_KEYWORD} AS word,
               list_filter(regexp_extract_all(sql, '(?i)dataset_marts\\.(\\w+)', 1),
                           lambda t: lower(t) NOT IN {tuple(ALLOWED_TABLES)!r})[1] AS stray
        FROM generated_sql)
    SELECT event_id, sql,
           CASE WHEN word IS NOT NULL THEN 'Forbidden keyword: ' || word
                WHEN stray IS NOT NULL THEN 'Table not in allow-list: ' || stray ELSE '' END
               AS reason,
           word IS NULL AND stray IS NULL AS is_valid
    FROM found"""
STATEMENTS["g2_missing_statement"] = """
    SELECT event_id, CASE WHEN event_type = 'view' THEN 'No statement' ELSE '' END AS reason,
           event_type <> 'view' AS is_valid
    FROM events"""
TABLES["parsed"] = r"""
    SELECT conv_id, turn,
           CASE WHEN kind IN (0, 1, 5) THEN statement
                WHEN kind = 4 THEN 'SELECT 1' END AS sql,
           CASE WHEN kind IN (0, 1, 5) THEN text END AS explanation,
           CASE WHEN kind IN (0, 1, 5) THEN 'mart_sales,' || role WHEN kind = 4 THEN '' END
               AS tables_used,
           CASE kind WHEN 2 THEN 'No JSON in response: '
                         || left(regexp_replace(text, '^\s+|\s+$', '', 'g'), 300)
                     WHEN 3 THEN 'Failed to parse response: '
                         || left('{"sql": cut ' || text || '}', 300) END AS error
    FROM replies"""
STATEMENTS["g3_parse_answer"] = "SELECT * FROM parsed"
STATEMENTS["g3_answer_verdicts"] = f"""
    SELECT p.conv_id, p.turn, sql,
           CASE WHEN {_HAS_EMAIL} OR {_HAS_PHONE}
                THEN 'Question contains personal data. Please rephrase.'
                WHEN error IS NOT NULL THEN error
                WHEN contains(sql, 'truncate')
                THEN 'SQL validation failed: Forbidden keyword: TRUNCATE'
                WHEN contains(sql, 'mart_customers')
                THEN 'SQL validation failed: Table not in allow-list: mart_customers' END AS error
    FROM parsed p JOIN conversations c ON c.conv_id = p.conv_id AND c.turn = p.turn"""
STATEMENTS["g4_queries_by_table"] = """
    SELECT table_name, COUNT(*) AS query_count
    FROM (SELECT unnest(tables_referenced) AS table_name FROM audit_log) GROUP BY 1"""
STATEMENTS["g4_tokens_by_user"] = """
    SELECT COALESCE(user_id, 'anonymous') AS user_id, COUNT(*) AS query_count,
           CAST(SUM(COALESCE(tokens_used, 0)) AS BIGINT) AS tokens_used
    FROM audit_log GROUP BY 1"""


def _needed(sql: str, found: list[str]) -> None:
    """Names of the subqueries that ``sql`` refers to, inner ones first."""
    for name, body in TABLES.items():
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(body, found)
            if name not in found:
                found.append(name)


def oracle_statements() -> dict[str, str]:
    statements = {}
    for key, sql in STATEMENTS.items():
        names: list[str] = []
        _needed(sql, names)
        parts = ", ".join(f"{name} AS ({TABLES[name]})" for name in names)
        statements[key] = f"WITH {parts} SELECT * FROM ({sql})" if names else sql
    return statements
