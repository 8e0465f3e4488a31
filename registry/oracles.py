"""SQL twins of the queries, for an independent engine over the same tables.

The shared prefix rebuilds the input tables and the two core tables. Scores use
plain global windows here; the Spark side has no such window.
"""

from __future__ import annotations

from registry import logistic

PREFIX = """
WITH txn AS (
  SELECT o_orderkey::VARCHAR AS transaction_id, o_orderkey::VARCHAR AS order_key,
         (CASE WHEN o_orderkey % 47 = 0 THEN -o_custkey ELSE o_custkey END)::VARCHAR AS customer_id,
         ((CASE WHEN o_orderkey % 40 = 39 THEN -1 ELSE 1 END)
          * (o_orderkey % (SELECT max(p_partkey) FROM part) + 1))::VARCHAR AS product_id,
         o_orderdate AS order_date, o_totalprice::DECIMAL(18,2) AS order_value,
         (CASE WHEN o_orderkey % 23 = 0 THEN 1 ELSE 0 END)::INT AS fraud_label,
         o_orderpriority AS payment_method, o_orderstatus AS device_type,
         o_orderkey % 11 AS discount_units, (o_orderkey % 8)::INT AS shipping_delay_days
  FROM orders),
cust AS (
  SELECT c_custkey::VARCHAR AS customer_id, n_name AS country,
         (CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END)::INT AS churn_label,
         (18 + c_custkey % 60)::INT AS age,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         c_acctbal AS loyalty_score,
         TIMESTAMP '1994-01-01' + to_days((c_custkey % 365)::INT) AS registration_date
  FROM customer, nation WHERE n_nationkey = c_nationkey),
prod AS (
  SELECT p_partkey::VARCHAR AS product_id, split_part(p_type, ' ', 1) AS category,
         p_size::DECIMAL(8,2) AS margin_percentage, p_retailprice AS popularity_score
  FROM part),
beh AS (
  SELECT user_id::VARCHAR AS customer_id,
         count(*) FILTER (event_type = 'view') AS views,
         count(*) FILTER (event_type = 'click') AS clicks,
         count(*) FILTER (event_type = 'purchase') AS purchases,
         count(*) FILTER (event_type = 'error') AS errors,
         count(*) FILTER (event_type = 'signup') AS signups,
         sum(value::DECIMAL(18,6))::DOUBLE / count(value) AS avg_event_value,
         (count(*) FILTER (event_type = 'error')) / count(*) AS behavior_churn_signal
  FROM events GROUP BY ALL),
fact AS (
  SELECT txn.*, country, churn_label, category, margin_percentage,
         order_value * margin_percentage AS profit100
  FROM txn LEFT JOIN cust USING (customer_id) LEFT JOIN prod USING (product_id)),
lines AS (
  SELECT l_orderkey::VARCHAR AS order_key, part_id AS product_id,
         l_extendedprice::DECIMAL(18,2) AS order_value, category, margin_percentage,
         l_extendedprice::DECIMAL(18,2) * margin_percentage AS profit100
  FROM (SELECT *, (CASE WHEN l_orderkey % 40 = 39 THEN -l_partkey ELSE l_partkey END)::VARCHAR AS part_id
        FROM lineitem) LEFT JOIN prod ON prod.product_id = part_id),
ppl AS (
  SELECT customer_id, sum(order_value) AS gmv, count(DISTINCT transaction_id) AS orders,
         min(order_date) AS first_order, max(order_date) AS last_order
  FROM txn GROUP BY customer_id),
churn AS (
  SELECT customer_id, arg_min(churn_label, order_date) AS churn_label
  FROM fact WHERE churn_label IS NOT NULL GROUP BY customer_id),
pplc AS (SELECT ppl.*, churn_label FROM ppl LEFT JOIN churn USING (customer_id)),
base AS (
  SELECT customer_id,
         date_sub('day', last_order, (SELECT max(order_date) FROM txn))::INT AS recency,
         orders AS frequency, gmv AS monetary
  FROM ppl),
placed AS (
  SELECT *, count(*) OVER () AS n,
         row_number() OVER (ORDER BY frequency, customer_id) - 1 AS f0,
         row_number() OVER (ORDER BY monetary, customer_id) - 1 AS m0,
         ntile(3) OVER (ORDER BY recency, customer_id) AS rt,
         ntile(3) OVER (ORDER BY frequency, customer_id) AS ft,
         ntile(3) OVER (ORDER BY monetary, customer_id) AS mt
  FROM base),
cuts AS (SELECT quantile_cont(recency, [1/3, 2/3]) AS q FROM base),
rfmq AS (
  SELECT customer_id, recency, frequency, monetary,
         (CASE WHEN recency <= q[1] THEN 3 WHEN recency <= q[2] THEN 2 ELSE 1 END)::INT AS r_score,
         (CASE WHEN 3*f0 <= n-1 THEN 1 WHEN 3*f0 <= 2*(n-1) THEN 2 ELSE 3 END)::INT AS f_score,
         (CASE WHEN 3*m0 <= n-1 THEN 1 WHEN 3*m0 <= 2*(n-1) THEN 2 ELSE 3 END)::INT AS m_score,
         concat(r_score, f_score, m_score) AS segment
  FROM placed, cuts),
rfmt AS (
  SELECT customer_id, recency, frequency, monetary,
         (4 - rt)::INT AS r_score, ft::INT AS f_score, mt::INT AS m_score,
         concat(r_score, f_score, m_score) AS segment
  FROM placed),
vis AS (
  SELECT customer_id, order_key, min(order_date) AS visited FROM txn GROUP BY ALL),
months AS (
  SELECT DISTINCT customer_id, date_trunc('month', visited)::DATE AS m FROM vis),
lab AS (
  SELECT customer_id, m, min(m) OVER (PARTITION BY customer_id) AS cohort FROM months),
act AS (
  SELECT cohort, date_diff('month', cohort, m)::INT AS period_n,
         count(DISTINCT customer_id) AS active_n
  FROM lab GROUP BY ALL),
size AS (
  SELECT cohort, count(DISTINCT customer_id) AS cohort_size FROM lab GROUP BY cohort),
grid AS (
  SELECT cohort, cohort_size, period_n, coalesce(active_n, 0) AS active_n,
         coalesce(active_n, 0)::DOUBLE / cohort_size AS retention
  FROM (SELECT * FROM size, (SELECT DISTINCT period_n FROM act))
  LEFT JOIN act USING (cohort, period_n)),
feat AS (
  SELECT customer_id, count(DISTINCT transaction_id) AS orders_n,
         sum(order_value)::DOUBLE AS gmv,
         (sum(discount_units) / 100::DECIMAL(8,2))::DOUBLE / count(*) AS avg_discount,
         sum(shipping_delay_days)::DOUBLE / count(*) AS avg_ship_delay,
         sum(fraud_label)::DOUBLE / count(*) AS fraud_rate,
         sum(order_value)::DOUBLE / count(DISTINCT transaction_id) AS aov,
         date_sub('day', max(order_date), (SELECT max(order_date) FROM txn))::INT AS recency_days,
         date_sub('day', min(order_date), max(order_date))::INT AS tenure_days
  FROM txn GROUP BY customer_id),
scored AS (
  SELECT customer_id, churn_label AS label, orders / 30.0 AS score,
         CASE WHEN orders >= 10 THEN 1 ELSE 0 END AS prediction
  FROM pplc WHERE churn_label IS NOT NULL),
cells AS (
  SELECT label, count(*) AS support,
         count(*) FILTER (prediction = label) AS hit,
         (SELECT count(*) FROM scored s WHERE s.prediction = t.label) AS called
  FROM scored t GROUP BY label),
held AS (
  SELECT transaction_id, fraud_label AS label,
         row_number() OVER (PARTITION BY fraud_label ORDER BY md5(transaction_id || ':42'), transaction_id)
           <= floor(0.25 * count(*) OVER (PARTITION BY fraud_label) + 0.5) AS test
  FROM txn),
rates AS (
  SELECT label, support, hit, hit / called AS p, hit / support AS r,
         2.0 * hit / (called + support) AS f
  FROM cells)
"""

MEASURES = """sum(order_value)::DOUBLE AS gmv, count(DISTINCT order_key) AS orders,
  sum(order_value)::DOUBLE / count(DISTINCT order_key) AS aov"""
PROFIT = "sum(profit100)::DOUBLE / 100.0"
MARGIN = f"100.0 * ({PROFIT}) / sum(order_value)::DOUBLE"
MIDDLE = "quantile_cont({0}::DOUBLE, 0.5)"
LTV = "min(gmv)::DOUBLE AS ltv_min, max(gmv)::DOUBLE AS ltv_max"
REPEAT = "round(100.0 * count(*) FILTER (orders >= 2) / count(*), 1) AS repeat_pct"
FRAUD = """count(DISTINCT order_key) AS orders, sum(fraud_label)::BIGINT AS fraud_n,
  sum(order_value)::DOUBLE AS gmv,
  round(100.0 * sum(fraud_label) / count(DISTINCT order_key), 2) AS fraud_pct"""
SEGMENTS = """SELECT segment, count(*) AS customers, round(sum(monetary)::DOUBLE, 0) AS gmv
  FROM {0} GROUP BY segment ORDER BY customers DESC, segment LIMIT 10"""
SHARE = "round(100.0 * (sum(monetary) FILTER ({0}))::DOUBLE / sum(monetary)::DOUBLE, 1)"
CHAMPIONS = f"""count(*) FILTER (segment = '333') AS champions,
  coalesce({SHARE.format("segment = '333'")}, 0) AS champions_gmv_pct,
  count(*) FILTER (r_score = 1) AS cold,
  coalesce({SHARE.format("r_score = 1")}, 0) AS cold_gmv_pct"""
ORDER_COLUMNS = """transaction_id, order_key, customer_id, product_id, order_date,
  order_value::DOUBLE AS order_value, country, category,
  margin_percentage::DOUBLE AS margin_percentage, churn_label, fraud_label,
  payment_method, device_type"""
TXN_REST = """(discount_units / 100.0)::DOUBLE AS discount_applied, shipping_delay_days"""

# Text orders as the typing step reads them; the CSV reader knows words for missing values.
TYPED = """SELECT transaction_id, customer_id, product_id,
  CASE WHEN o_orderkey % 89 <> 0 THEN order_date::DATE::TIMESTAMP END AS order_date,
  CASE WHEN o_orderkey % 97 <> 0 THEN (order_value::DECIMAL(18,3)
    + CASE WHEN o_orderkey % 5 = 0 THEN 0.005 ELSE 0 END)::DOUBLE END AS order_value,
  CASE WHEN o_orderkey % 31 <> 0 THEN 'say "hi",' || if(o_orderkey % 3 = 0, chr(10), ' ') || 'order ' || (o_orderkey % 7)
    ELSE {0} END AS note
  FROM txn JOIN orders ON o_orderkey::VARCHAR = transaction_id"""
FROM_CSV, FROM_TEXT = TYPED.format("NULL"), TYPED.format("'NA'")

_BODIES = {
    # sources and sinks
    "src_csv": FROM_CSV,
    "sink_parquet": """SELECT transaction_id, customer_id, country, category,
      order_value::DOUBLE AS order_value, gmv::DOUBLE AS gmv, orders
      FROM fact JOIN ppl USING (customer_id)""",
    "people_rfm": """SELECT ppl.customer_id, gmv::DOUBLE AS gmv, orders, first_order,
      segment, r_score AS R FROM ppl JOIN rfmq USING (customer_id)""",
    "publish_orders": f"SELECT {ORDER_COLUMNS}, profit100::DOUBLE / 100.0 AS profit FROM fact",
    "publish_people": """SELECT customer_id, gmv::DOUBLE AS gmv, orders, first_order, segment,
      r_score AS R, churn_label FROM pplc JOIN rfmq USING (customer_id)""",
    "sql_views": """SELECT segment, count(*) AS customers, sum(monetary)::DOUBLE AS gmv
      FROM rfmq GROUP BY segment""",
    "preview_orders": """SELECT transaction_id, order_key, customer_id,
      order_value::DOUBLE AS order_value, order_date, country
      FROM fact ORDER BY order_key LIMIT 5""",
    "preview_people": """SELECT customer_id, gmv::DOUBLE AS gmv, orders, first_order, churn_label
      FROM pplc ORDER BY customer_id LIMIT 5""",
    # typing and checks
    "typed_orders": FROM_TEXT,
    "grain_orders": """SELECT count(*) AS rows_n, count(DISTINCT o_orderkey) AS orders_n,
      if(count(*) > 1.2 * count(DISTINCT o_orderkey), 'line', 'order') AS grain FROM orders""",
    "grain_lines": """SELECT count(*) AS rows_n, count(DISTINCT l_orderkey) AS orders_n,
      if(count(*) > 1.2 * count(DISTINCT l_orderkey), 'line', 'order') AS grain FROM lineitem""",
    "sanity_check": f"""SELECT count(*) AS rows_raw, count(*) AS rows_clean,
      0.0::DOUBLE AS dropped_pct, count(DISTINCT transaction_id) AS orders_raw,
      count(DISTINCT transaction_id) AS orders_clean,
      sum(order_value::DECIMAL(18,3))::DOUBLE AS gmv, min(order_value) AS money_min,
      {MIDDLE.format("order_value")} AS money_median, max(order_value) AS money_max,
      min(order_date) AS date_min, max(order_date) AS date_max,
      count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ({FROM_TEXT}))) AS duplicate_rows,
      count(*) FILTER (customer_id IS NULL) AS missing_customers,
      count(DISTINCT customer_id) AS customers_n, count(DISTINCT product_id) AS products_n
      FROM ({FROM_TEXT})""",
    "duplicate_rows": """SELECT 'orders' AS source, count(*) AS rows_n,
      count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders)) AS duplicate_rows
      FROM orders UNION ALL
      SELECT 'lines', count(*), count(*) - (SELECT count(*) FROM
        (SELECT DISTINCT * FROM lineitem)) FROM lineitem""",
    "bad_orders": """SELECT 'orders' AS source, count(*) AS bad_orders FROM (
        SELECT order_key FROM txn GROUP BY order_key
        HAVING greatest(count(DISTINCT customer_id), count(DISTINCT order_date)) > 1)
      UNION ALL SELECT 'shipments', count(*) FROM (
        SELECT l_orderkey FROM lineitem GROUP BY l_orderkey
        HAVING greatest(count(DISTINCT l_suppkey), count(DISTINCT l_shipdate)) > 1)""",
    "bad_orders_by_day": """SELECT 'orders' AS source, count(*) AS bad_orders FROM (
        SELECT order_key FROM txn GROUP BY order_key
        HAVING greatest(count(DISTINCT customer_id), count(DISTINCT order_date::DATE)) > 1)
      UNION ALL SELECT 'events', count(*) FROM (
        SELECT user_id FROM events GROUP BY user_id HAVING count(DISTINCT ts::DATE) > 1)""",
    "dim_duplicates": """SELECT 'customers' AS dim, count(*) AS rows_n,
        count(*) - count(DISTINCT customer_id) AS duplicate_keys FROM cust
      UNION ALL SELECT 'products', count(*), count(*) - count(DISTINCT product_id) FROM prod
      UNION ALL SELECT 'behavior', count(*), count(*) - count(DISTINCT customer_id) FROM beh""",
    "orphan_keys": """SELECT 'customers' AS dim, count(*) AS orphan_rows FROM txn
        WHERE customer_id NOT IN (SELECT customer_id FROM cust)
      UNION ALL SELECT 'products', count(*) FROM txn
        WHERE product_id NOT IN (SELECT product_id FROM prod)
      UNION ALL SELECT 'behavior', count(*) FROM txn
        WHERE customer_id NOT IN (SELECT customer_id FROM beh)""",
    "join_inflation": """SELECT 'before' AS stage, count(*) AS rows_n,
        sum(order_value)::DOUBLE AS gmv FROM txn
      UNION ALL SELECT 'after', count(*), sum(order_value)::DOUBLE
        FROM fact LEFT JOIN beh USING (customer_id)""",
    "mixed_churn": """SELECT 'churn_label' AS label, count(*) FILTER (a > 1) AS mixed_customers
        FROM (SELECT count(DISTINCT churn_label) AS a FROM fact GROUP BY customer_id)
      UNION ALL SELECT 'fraud_label', count(*) FILTER (a > 1)
        FROM (SELECT count(DISTINCT fraud_label) AS a FROM txn GROUP BY customer_id)""",
    "contract_check": " UNION ALL ".join(
        f"""SELECT '{table}' AS "table", '{column} is null' AS rule,
          count(*) FILTER ({column} IS NULL) AS rows_n FROM {cte}"""
        for table, cte, columns in (
            ("clean_orders", "txn", ["transaction_id", "order_key", "customer_id",
                                     "order_date", "order_value"]),
            ("people", "ppl", ["customer_id", "gmv", "orders", "first_order"]),
        )
        for column in columns
    )
    + """ UNION ALL SELECT 'clean_orders', 'transaction_id repeated',
        count(transaction_id) - count(DISTINCT transaction_id) FROM txn
      UNION ALL SELECT 'people', 'customer_id repeated',
        count(customer_id) - count(DISTINCT customer_id) FROM ppl""",
    "sanity_rows": "SELECT count(*) AS rows_n FROM orders",
    "sanity_sql": f"""SELECT count(DISTINCT order_key) AS orders_n,
      sum(order_value)::DOUBLE AS gmv, {PROFIT} AS profit, min(order_date) AS date_min,
      max(order_date) AS date_max, count(DISTINCT customer_id) AS customers_n FROM fact""",
    "sanity_people": """SELECT count(*) AS people_n, sum(gmv)::DOUBLE AS gmv_people FROM ppl""",
    # tables
    "clean_orders": f"SELECT {ORDER_COLUMNS}, {TXN_REST} FROM fact",
    "clean_lines": """SELECT order_key AS transaction_id, order_key, lines.product_id,
      lines.order_value::DOUBLE AS order_value, customer_id, order_date, country, churn_label,
      lines.category, lines.margin_percentage::DOUBLE AS margin_percentage
      FROM lines JOIN txn USING (order_key) LEFT JOIN cust USING (customer_id)""",
    "clean_behavior": f"""SELECT txn.* EXCLUDE (order_value, discount_units, shipping_delay_days),
      order_value::DOUBLE AS order_value, {TXN_REST}, beh.* EXCLUDE (customer_id)
      FROM txn LEFT JOIN beh USING (customer_id)""",
    "people": "SELECT customer_id, gmv::DOUBLE AS gmv, orders, first_order FROM ppl",
    "customer_churn": "SELECT customer_id, churn_label FROM churn",
    # sales
    "kpi_totals": f"""SELECT {MEASURES}, min(order_value)::DOUBLE AS money_min,
      {MIDDLE.format("order_value")} AS money_median, max(order_value)::DOUBLE AS money_max,
      min(order_date) AS date_min, max(order_date) AS date_max FROM fact""",
    "kpi_totals_sql": f"SELECT {MEASURES} FROM fact",
    "kpi_country": f"SELECT country, {MEASURES} FROM fact WHERE country IS NOT NULL GROUP BY 1",
    "kpi_country_sql": f"SELECT country, {MEASURES} FROM fact GROUP BY 1",
    "kpi_year_month": f"""SELECT year(order_date)::INT AS year, month(order_date)::INT AS month,
      {MEASURES} FROM fact GROUP BY 1, 2""",
    # customers
    "people_summary": f"""SELECT count(*) AS customers, {REPEAT}, {LTV},
      count(*) FILTER (orders >= 2) AS repeaters, {MIDDLE.format("gmv")} AS ltv_median,
      sum(gmv)::DOUBLE AS gmv_people FROM ppl""",
    "kpi_repeat": f"""SELECT count(*) AS customers, {REPEAT}, {LTV},
      count(*) FILTER (orders >= 2) AS repeaters, {MIDDLE.format("gmv")} AS ltv_median,
      sum(gmv)::DOUBLE AS gmv_people, min(orders) AS purchases_min,
      {MIDDLE.format("orders")} AS purchases_median, max(orders) AS purchases_max FROM ppl""",
    "kpi_repeat_sql": f"""SELECT count(*) AS customers, {REPEAT}, {LTV},
      min(orders) AS purchases_min, max(orders) AS purchases_max,
      round(sum(orders)::DOUBLE / count(*), 1) AS purchases_avg,
      round(sum(gmv)::DOUBLE / count(*), 1) AS ltv_avg,
      round(sum(gmv)::DOUBLE, 0) AS gmv_people FROM ppl""",
    "kpi_medians_sql": """SELECT 'purchases' AS metric,
        quantile_disc(orders, 0.5)::DOUBLE AS median_value FROM ppl
      UNION ALL SELECT 'ltv', quantile_disc(gmv, 0.5)::DOUBLE FROM ppl""",
    "churn_slice": f"""SELECT churn_label, count(*) AS customers,
      {MIDDLE.format("orders")} AS purchases_median, {MIDDLE.format("gmv")} AS ltv_median,
      sum(gmv)::DOUBLE AS gmv,
      round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS customers_pct,
      round(100.0 * sum(gmv)::DOUBLE / (SELECT sum(gmv)::DOUBLE FROM ppl), 1) AS gmv_pct
      FROM pplc WHERE churn_label IS NOT NULL GROUP BY churn_label""",
    "churn_slice_sql": """SELECT churn_label, count(*) AS customers,
      round(sum(orders)::DOUBLE / count(*), 1) AS purchases_avg,
      round(sum(gmv)::DOUBLE, 0) AS gmv,
      round(100.0 * count(*) / (SELECT count(*) FROM ppl), 1) AS customers_pct,
      round(100.0 * sum(gmv)::DOUBLE / (SELECT sum(gmv)::DOUBLE FROM ppl), 1) AS gmv_pct
      FROM pplc GROUP BY churn_label""",
    # cohorts
    "customer_cohort": "SELECT DISTINCT customer_id, cohort FROM lab",
    "cohort_size": "SELECT cohort, cohort_size FROM size",
    "cohort_active": "SELECT cohort, period_n, active_n FROM act",
    "retention_long": """SELECT cohort, period_n, active_n, cohort_size,
      round(active_n::DOUBLE / cohort_size, 3) AS retention
      FROM act JOIN size USING (cohort) WHERE period_n <= 7
      ORDER BY cohort, period_n LIMIT 50""",
    "retention_matrix": "SELECT cohort, "
    + ", ".join(
        f"round(coalesce(max(retention) FILTER (period_n = {p}), 0), 3) AS period_{p}"
        for p in range(8)
    )
    + " FROM grid GROUP BY cohort",
    "retention_full": "SELECT cohort, cohort_size, period_n, active_n, retention FROM grid",
    "retention_m1_median": """SELECT round(quantile_cont(retention, 0.5), 3) AS period_1_median
      FROM grid WHERE period_n = 1""",
    "cohort_summary": f"""SELECT count(*) AS cohorts, min(cohort_size) AS size_min,
      {MIDDLE.format("cohort_size")} AS size_median, max(cohort_size) AS size_max FROM size""",
    "cohort_summary_sql": """SELECT count(*) AS cohorts_n, min(n) AS size_min, max(n) AS size_max
      FROM (SELECT count(*) AS n FROM ppl GROUP BY date_trunc('month', first_order))""",
    # recency, frequency, monetary
    "rfm_customers": "SELECT * REPLACE (monetary::DOUBLE AS monetary) FROM rfmq",
    "rfm_ranks": """SELECT customer_id, row_number() OVER (ORDER BY orders, customer_id) AS frequency_rank,
      row_number() OVER (ORDER BY gmv, customer_id) AS monetary_rank FROM ppl""",
    "rfm_segments": SEGMENTS.format("rfmq"),
    "recency_summary": f"""SELECT min(recency) AS recency_min,
      {MIDDLE.format("recency")} AS recency_median, max(recency) AS recency_max FROM base""",
    "rfm_champions": f"""SELECT {CHAMPIONS},
      round(100.0 * count(*) FILTER (r_score = 1) / count(*), 1) AS cold_pct FROM rfmq""",
    "rfm_by_recency": "SELECT r_score, count(*) AS customers FROM rfmq GROUP BY r_score",
    "rfm_sql_customers": "SELECT * REPLACE (monetary::DOUBLE AS monetary) FROM rfmt",
    "rfm_sql_segments": SEGMENTS.format("rfmt"),
    "rfm_sql_champions": f"SELECT {CHAMPIONS} FROM rfmt",
    "recency_summary_sql": """SELECT min(recency) AS recency_min,
      sum(recency)::DOUBLE / count(*) AS recency_avg, max(recency) AS recency_max FROM base""",
    # products
    "kpi_margin": f"""SELECT count(DISTINCT product_id) AS sku, sum(order_value)::DOUBLE AS gmv,
      {PROFIT} AS profit, round({MARGIN}, 1) AS margin_pct FROM lines""",
    "product_kpi": f"""SELECT product_id, {MEASURES}, {PROFIT} AS profit, {MARGIN} AS margin_pct
      FROM lines GROUP BY product_id""",
    "top_products": f"""SELECT product_id, {MEASURES}, {PROFIT} AS profit,
      round({MARGIN}, 1) AS margin_pct FROM lines GROUP BY product_id
      ORDER BY gmv DESC, product_id LIMIT 10""",
    "kpi_category": f"""SELECT category, {MEASURES}, {PROFIT} AS profit, {MARGIN} AS margin_pct
      FROM lines WHERE category IS NOT NULL GROUP BY category""",
    "kpi_category_sql": f"""SELECT category, {MEASURES}, {PROFIT} AS profit,
      round({MARGIN}, 1) AS margin_pct FROM lines GROUP BY category""",
    # fraud
    "fraud_overall": """SELECT round(100.0 * sum(fraud_label) / count(fraud_label), 2) AS fraud_pct,
      sum(fraud_label)::BIGINT AS fraud_rows, count(*) AS rows_n FROM fact""",
    "fraud_by_payment": f"SELECT payment_method, {FRAUD} FROM fact GROUP BY 1",
    "fraud_by_device": f"SELECT device_type, {FRAUD} FROM fact GROUP BY 1",
    # dashboard
    "bi_sales": f"""SELECT {MEASURES}, {PROFIT} AS profit_total,
      ({PROFIT}) / sum(order_value)::DOUBLE AS margin FROM fact""",
    "bi_customers": f"""SELECT count(*) AS customers, {MIDDLE.format("gmv")} AS ltv_median,
      count(*) FILTER (orders >= 2)::DOUBLE / count(*) AS repeat_share FROM ppl""",
    "bi_fraud": "SELECT sum(fraud_label)::DOUBLE / count(*) AS fraud_share FROM fact",
    # models
    "txn_features": "SELECT * FROM feat",
    "churn_features": """SELECT customer_id, country, age, gender, loyalty_score, churn_label AS label,
      beh.* EXCLUDE (customer_id, behavior_churn_signal),
      coalesce(orders_n, 0) AS orders_n, coalesce(gmv, 0) AS gmv, coalesce(aov, 0) AS aov,
      coalesce(avg_discount, 0) AS avg_discount, coalesce(avg_ship_delay, 0) AS avg_ship_delay,
      coalesce(fraud_rate, 0) AS fraud_rate, coalesce(recency_days, 0) AS recency_days,
      coalesce(tenure_days, 0) AS tenure_days,
      date_sub('day', registration_date, (SELECT max(order_date) FROM txn))::INT
        AS reg_tenure_days
      FROM cust LEFT JOIN beh USING (customer_id) LEFT JOIN feat USING (customer_id)""",
    "fraud_features": f"""SELECT transaction_id, fraud_label AS label,
      order_value::DOUBLE AS order_value, payment_method, device_type, {TXN_REST},
      age, gender, cust.country, loyalty_score, prod.category,
      prod.margin_percentage::DOUBLE AS margin_percentage, popularity_score
      FROM txn LEFT JOIN cust USING (customer_id) LEFT JOIN prod USING (product_id)""",
    "label_share": """SELECT 'churn' AS label, count(*) AS rows_n,
        round(100.0 * sum(churn_label) / count(*), 1) AS label_pct FROM cust
      UNION ALL SELECT 'fraud', count(*), round(100.0 * sum(fraud_label) / count(*), 2) FROM txn""",
    "split_shares": """SELECT if(test, 'test', 'train') AS side, count(*) AS rows_n,
      sum(label)::BIGINT AS positives, sum(label) / count(*) AS positive_share
      FROM held GROUP BY 1""",
    "split_rows": "SELECT transaction_id, label FROM held WHERE test",
    "model_auc": """SELECT count(*) AS rows_n, round((sum(place) FILTER (label = 1)
        - pos * (pos + 1) / 2) / (pos * (count(*) - pos)), 12) AS auc
      FROM (SELECT label, count(*) FILTER (label = 1) OVER () AS pos,
        rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS place
        FROM scored) GROUP BY pos""",
    "confusion": """SELECT label, count(*) FILTER (prediction = 0) AS predicted_0,
      count(*) FILTER (prediction = 1) AS predicted_1 FROM scored GROUP BY label""",
    "class_report": """SELECT label::VARCHAR AS "class", round(p, 3) AS "precision",
        round(r, 3) AS recall, round(f, 3) AS f1, support FROM rates
      UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hit) / sum(support), 3),
        sum(support)::BIGINT FROM rates
      UNION ALL SELECT 'macro avg', round(avg(p), 3), round(avg(r), 3), round(avg(f), 3),
        sum(support)::BIGINT FROM rates
      UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 3),
        round(sum(r * support) / sum(support), 3), round(sum(f * support) / sum(support), 3),
        sum(support)::BIGINT FROM rates""",
}

# The features of the two logistic regressions.
_CHURN_NUMBERS = [
    "age", "loyalty_score", "views", "clicks", "purchases", "errors", "signups", "avg_event_value", "orders_n", "gmv",
    "aov", "avg_discount", "avg_ship_delay", "fraud_rate", "recency_days", "tenure_days", "reg_tenure_days",
]
_FRAUD_NUMBERS = [
    "order_value", "discount_applied", "shipping_delay_days", "age", "loyalty_score", "margin_percentage", "popularity_score",
]
_FRAUD_LEVELS = ["payment_method", "device_type", "gender", "country", "category"]

ORACLES = {
    **{name: PREFIX + body for name, body in _BODIES.items()},
    **logistic.twins(
        PREFIX, "churn", _BODIES["churn_features"], "customer_id", _CHURN_NUMBERS, ["gender", "country"]
    ),
    **logistic.twins(PREFIX, "fraud", _BODIES["fraud_features"], "transaction_id", _FRAUD_NUMBERS, _FRAUD_LEVELS),
}
