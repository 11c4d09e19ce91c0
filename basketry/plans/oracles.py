"""The same results as plain DuckDB SQL over the star tables, joined as defined.

Nothing here is used by the engine; the SQL is the independent side of the check.
Sums of money are taken in whole ten-thousandths, as the engine does.
"""

from __future__ import annotations

from basketry.schemas import RAW_TABLES

RAW = r"""
raw_customers AS (
  SELECT c_custkey AS customer_id, concat('city_', c_nationkey) AS city,
         CASE WHEN c_custkey % 20 = 0 THEN lower(n_name) ELSE n_name END AS state
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
order_rows AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
              ELSE 'processing' END AS order_status,
         o_orderdate AS purchase_ts, o_orderdate + INTERVAL 1 DAY AS approved_ts,
         o_orderdate + (7 + o_orderkey % 14) * INTERVAL 1 DAY AS estimated_delivery_ts,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 50 <> 3
              THEN o_orderdate + (3 + (o_orderkey * 7) % 19) * INTERVAL 1 DAY
                   + (o_orderkey % 24) * INTERVAL 1 HOUR END AS delivered_ts
  FROM orders),
raw_orders AS (
  SELECT * FROM order_rows UNION ALL SELECT * FROM order_rows WHERE order_id % 67 = 0),
raw_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS item_no, l_partkey AS product_id,
         l_suppkey AS seller_id, p_type AS category,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS freight_value
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey),
payment_rows AS (
  SELECT o_orderkey AS order_id,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto'
              WHEN '3-MEDIUM' THEN 'voucher' WHEN '5-LOW' THEN 'debit_card' END AS payment_type,
         CAST(1 + o_orderkey % 10 AS INTEGER) AS installments,
         CASE WHEN o_orderkey % 100 = 2 THEN NULL WHEN o_orderkey % 100 = 1 THEN -o_totalprice
              ELSE o_totalprice END AS payment_value
  FROM orders),
raw_payments AS (
  SELECT * FROM payment_rows
  UNION ALL SELECT order_id, 'voucher', 1, payment_value FROM payment_rows WHERE order_id % 25 = 0),
raw_reviews AS (
  SELECT o_orderkey AS order_id, CAST(o_orderkey % 7 AS INTEGER) AS review_score
  FROM orders WHERE o_orderkey % 12 <> 0
  UNION ALL SELECT o_orderkey, 5 FROM orders WHERE o_orderkey % 91 = 0)
"""

# From here on only raw_customers, raw_orders, raw_items, raw_payments, raw_reviews are read.
DERIVED = r"""
stg_customers AS (SELECT customer_id, city, upper(state) AS state FROM raw_customers),
stg_orders AS (SELECT DISTINCT * FROM raw_orders),
stg_payments AS (
  SELECT *, CASE WHEN payment_value IS NULL THEN 'missing_value'
                 WHEN payment_value < 0 THEN 'negative_value' ELSE 'ok' END AS payment_quality_flag
  FROM raw_payments),
stg_reviews AS (SELECT * FROM raw_reviews WHERE review_score BETWEEN 1 AND 5),
items_of_order AS (
  SELECT order_id, count(*) AS n_items, sum(price) AS merchandise_value,
         sum(freight_value) AS freight_value, sum(price + freight_value) AS order_value
  FROM raw_items GROUP BY order_id),
economics AS (
  SELECT o.order_id, customer_id, order_status, purchase_ts, estimated_delivery_ts, delivered_ts,
         n_items, merchandise_value, freight_value, order_value,
         CAST(date_part('day', delivered_ts - estimated_delivery_ts) AS INTEGER) AS delivery_delta_days,
         CASE WHEN delivered_ts IS NOT NULL AND delivered_ts > estimated_delivery_ts
              THEN 1 ELSE 0 END AS was_late
  FROM stg_orders o LEFT JOIN items_of_order i ON i.order_id = o.order_id
  WHERE order_status = 'delivered'),
order_review AS (
  SELECT e.order_id, e.customer_id, e.order_value, e.was_late, r.review_score, p.payment_type,
         p.installments, p.payment_value, p.payment_quality_flag
  FROM economics e LEFT JOIN stg_reviews r ON r.order_id = e.order_id
                   LEFT JOIN stg_payments p ON p.order_id = e.order_id),
sequence AS (
  SELECT order_id, customer_id, purchase_ts, order_value,
         row_number() OVER w AS order_seq_num, lag(purchase_ts) OVER w AS prev_order_ts,
         count(*) OVER (PARTITION BY customer_id) AS lifetime_order_count
  FROM economics
  WINDOW w AS (PARTITION BY customer_id ORDER BY purchase_ts NULLS LAST, order_id)),
customer_sums AS (
  SELECT c.customer_id, c.state, s.lifetime_order_count,
         CAST(sum(e.order_value) * 10000 AS HUGEINT) AS value_units,
         count(e.order_value) AS value_rows, sum(e.was_late) AS late_rows, count(*) AS all_rows,
         sum(r.review_score) AS score_sum, count(r.review_score) AS n_reviews,
         min(e.purchase_ts) AS first_purchase_ts, max(e.purchase_ts) AS last_purchase_ts
  FROM stg_customers c JOIN economics e ON e.customer_id = c.customer_id
       JOIN sequence s ON s.order_id = e.order_id
       LEFT JOIN stg_reviews r ON r.order_id = e.order_id
  GROUP BY c.customer_id, c.state, s.lifetime_order_count),
customers_mart AS (
  SELECT customer_id, state, lifetime_order_count,
         CASE WHEN lifetime_order_count > 1 THEN 1 ELSE 0 END AS is_repeat_customer,
         ((200 * value_units + 10000 * value_rows) // (20000 * nullif(value_rows, 0)))
           / CAST(100 AS DOUBLE) AS avg_order_value,
         ((200 * value_units + 10000) // 20000) / CAST(100 AS DOUBLE) AS lifetime_value,
         ((2000 * late_rows + all_rows) // (2 * all_rows)) / CAST(10 AS DOUBLE) AS pct_orders_late,
         ((200 * score_sum + n_reviews) // (2 * nullif(n_reviews, 0))) / CAST(100 AS DOUBLE)
           AS avg_review_score,
         first_purchase_ts, last_purchase_ts
  FROM customer_sums),
orders_mart AS (
  SELECT o.order_id, o.customer_id, o.order_value, o.was_late, o.review_score, o.payment_type,
         o.installments, o.payment_quality_flag, s.order_seq_num,
         CASE WHEN s.order_seq_num > 1 THEN 1 ELSE 0 END AS is_repeat_order
  FROM order_review o JOIN sequence s ON s.order_id = o.order_id),
bounds AS (
  SELECT CAST(min(order_value) AS DOUBLE) - CASE WHEN min(order_value) = max(order_value)
           THEN 0.5 ELSE 0 END AS lo,
         CAST(max(order_value) AS DOUBLE) + CASE WHEN min(order_value) = max(order_value)
           THEN 0.5 ELSE 0 END AS hi FROM orders_mart),
assigned AS (
  SELECT *, CASE WHEN CAST(CAST(concat('0x', substr(md5(concat('7|g|', customer_id)), 1, 13)) AS BIGINT)
                           AS DOUBLE) / 4503599627370496e0 < 5e-1 THEN 'control' ELSE 'treatment' END AS "group",
         CAST(CAST(concat('0x', substr(md5(concat('7|o|', customer_id)), 1, 13)) AS BIGINT)
              AS DOUBLE) / 4503599627370496e0 AS u
  FROM customers_mart),
base AS (SELECT CAST(sum(is_repeat_customer) AS DOUBLE) / count(*) AS p FROM customers_mart),
outcome AS (
  SELECT a.*, CASE WHEN u < least(greatest(
           p + CASE WHEN "group" = 'treatment' THEN 4e0 / 1e2 ELSE 0e0 END, 0e0), 1e0)
         THEN 1 ELSE 0 END AS outcome
  FROM assigned a, base),
arms AS (
  SELECT count(*) FILTER ("group" = 'treatment') AS n1, count(*) FILTER ("group" = 'control') AS n0,
         CAST(sum(outcome) FILTER ("group" = 'treatment') AS DOUBLE) AS s1,
         CAST(sum(outcome) FILTER ("group" = 'control') AS DOUBLE) AS s0,
         CAST(sum(CAST(lifetime_value * 10000 AS HUGEINT)) AS DOUBLE) / (count(lifetime_value) * 10000) AS ltv,
         CAST(sum(CAST(avg_order_value * 10000 AS HUGEINT)) FILTER ("group" = 'treatment') AS DOUBLE)
           / 10000 AS treated_value
  FROM outcome),
z AS (
  SELECT *, s1 / n1 AS treatment_rate, s0 / n0 AS control_rate,
         (s1 / n1 - s0 / n0) * 100 AS absolute_lift_pp,
         (s1 / n1 - s0 / n0) / sqrt((s1 + s0) / (n1 + n0) * (1 - (s1 + s0) / (n1 + n0))
                                    * (1e0 / n1 + 1e0 / n0)) AS z_stat
  FROM arms),
ztest AS (
  SELECT *, 0.5e0 - (SELECT sum(CASE WHEN k = 0 OR k = 4000 THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END
                                * exp(-0.5e0 * pow(z_stat * k / 4e3, 2)))
                     FROM range(4001) t(k)) * z_stat / 4e3 / 3e0 / sqrt(2e0 * pi()) AS p_value
  FROM z),
business AS (
  SELECT *, absolute_lift_pp / 100 * n1 * ltv AS incremental_revenue,
         treated_value * 1e-1 AS discount_cost FROM ztest),
balance AS (
  SELECT n0 AS n_control, n1 AS n_treatment, m0 AS mean_control, m1 AS mean_treatment,
         (m0 - m1) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (1e0 / n0 + 1e0 / n1)) AS t,
         n0 + n1 - 2 AS dof
  FROM (SELECT count(avg_order_value) FILTER ("group" = 'control') AS n0,
               count(avg_order_value) FILTER ("group" = 'treatment') AS n1,
               avg(avg_order_value) FILTER ("group" = 'control') AS m0,
               avg(avg_order_value) FILTER ("group" = 'treatment') AS m1,
               var_samp(avg_order_value) FILTER ("group" = 'control') AS v0,
               var_samp(avg_order_value) FILTER ("group" = 'treatment') AS v1 FROM assigned)),
ttest AS (
  SELECT *, 1e0 - 2e0 * (SELECT sum(CASE WHEN k = 0 OR k = 4000 THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END
                                    * pow(1 + pow(t * k / 4e3, 2) / dof, -(dof + 1) / 2e0))
                         FROM range(4001) q(k)) * abs(t) / 4e3 / 3e0
                   * exp(lgamma((dof + 1) / 2e0) - lgamma(dof / 2e0)) / sqrt(dof * pi()) AS p_value
  FROM balance),
features AS (
  SELECT o.order_id, o.customer_id, CAST(o.order_value AS DOUBLE) AS order_value, o.was_late,
         o.review_score, o.payment_type, o.installments, c.state, c.is_repeat_customer
  FROM orders_mart o JOIN customers_mart c ON c.customer_id = o.customer_id
  WHERE o.order_seq_num = 1),
imputed AS (
  SELECT order_id, customer_id, state,
         coalesce(order_value, (SELECT median(order_value) FROM features)) AS order_value,
         CAST(coalesce(was_late, 0) AS DOUBLE) AS was_late,
         CAST(coalesce(installments, 1) AS DOUBLE) AS installments,
         coalesce(CAST(review_score AS DOUBLE), (SELECT median(review_score) FROM features)) AS review_score,
         coalesce(payment_type, 'unknown') AS payment_type, coalesce(is_repeat_customer, 0) AS is_repeat_customer
  FROM features),
onehot AS (
  SELECT order_id, customer_id, state, order_value, was_late, installments, review_score,
         CAST(payment_type = 'credit_card' AS DOUBLE) AS payment_type_credit_card,
         CAST(payment_type = 'debit_card' AS DOUBLE) AS payment_type_debit_card,
         CAST(payment_type = 'unknown' AS DOUBLE) AS payment_type_unknown,
         CAST(payment_type = 'voucher' AS DOUBLE) AS payment_type_voucher, is_repeat_customer
  FROM imputed),
splitted AS (
  SELECT *, CASE WHEN CAST(CAST(concat('0x', substr(md5(concat('42|s|', order_id)), 1, 13)) AS BIGINT)
                           AS DOUBLE) / 4503599627370496e0 < 75e-2 THEN 'train' ELSE 'test' END AS split
  FROM onehot),
drawn AS (
  SELECT *, CAST(CAST(concat('0x', substr(md5(concat('42|s|', order_id)), 1, 13)) AS BIGINT)
                 AS DOUBLE) / 4503599627370496e0 AS u FROM onehot),
limits AS (
  SELECT is_repeat_customer, coalesce(max(u) FILTER (k <= n - ceil(0.25e0 * n)), -1) AS largest FROM (
    SELECT is_repeat_customer, u, row_number() OVER (PARTITION BY is_repeat_customer ORDER BY u) AS k,
           count(*) OVER (PARTITION BY is_repeat_customer) AS n FROM drawn)
  GROUP BY is_repeat_customer),
stratified AS (
  SELECT drawn.* EXCLUDE (u), CASE WHEN u <= largest THEN 'train' ELSE 'test' END AS split
  FROM drawn JOIN limits USING (is_repeat_customer)),
test_scores AS (
  SELECT was_late AS label,
         floor((8e-1 * (CAST(CAST(concat('0x', substr(md5(concat('9|a|', order_id)), 1, 13)) AS BIGINT)
                             AS DOUBLE) / 4503599627370496e0) + 2e-1 * was_late) * 1000) / 1e3 AS score
  FROM economics),
matrix AS (
  SELECT count(*) FILTER (label = 0 AND score < 0.5) AS tn, count(*) FILTER (label = 0 AND score >= 0.5) AS fp,
         count(*) FILTER (label = 1 AND score < 0.5) AS fn, count(*) FILTER (label = 1 AND score >= 0.5) AS tp
  FROM test_scores)
"""

MARKET = r"""
market_customers AS (
  SELECT o_orderkey AS customer_id, o_custkey AS customer_unique_id,
         concat('city_', o_orderkey % 50) AS customer_city, n_name AS customer_state
  FROM orders LEFT JOIN (SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)
       ON c_custkey = o_custkey),
market_products AS (
  SELECT p_partkey AS product_id, CASE WHEN p_partkey % 11 <> 0 THEN p_type END AS name,
         CASE WHEN p_type <> 'ECONOMY' THEN concat('en_', lower(p_type)) END AS english
  FROM part)
"""

_SCALED = ("order_value", "was_late", "installments", "review_score", "payment_type_credit_card",
           "payment_type_debit_card", "payment_type_unknown", "payment_type_voucher")


def _scaled() -> str:
    learned = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALED)
    columns = ", ".join(
        f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}" for c in _SCALED)
    return (f"SELECT order_id, customer_id, split, {columns} FROM stratified, "
            f"(SELECT {learned} FROM stratified WHERE split = 'train')")


_DESCENTS = 500


def _fitted() -> str:
    """`fitted` (b, w0 …): gradient descent on weighted losses plus |w|²/2; `probability(rows)`."""
    k = range(len(_SCALED))
    learned = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALED)
    x = ", ".join(f"x{i}" for i in k)
    w = ", ".join(f"w{i}" for i in k)
    moved = ", ".join(f"w{i} - eta * (sum(g * x{i}) + w{i})" for i in k)
    return f""",
learned AS MATERIALIZED (SELECT {learned} FROM stratified WHERE split = 'train'),
sizes AS (SELECT is_repeat_customer, count(*) AS n, sum(count(*)) OVER () AS total
          FROM stratified WHERE split = 'train' GROUP BY is_repeat_customer),
learning AS MATERIALIZED (
  SELECT is_repeat_customer AS y, CAST(total AS DOUBLE) / (2 * n) AS c, 1e0 / (75e-2 * total + 1) AS eta, {_inputs()}
  FROM stratified JOIN sizes USING (is_repeat_customer), learned WHERE split = 'train'),
descent AS (
  SELECT 0 AS i, 0e0 AS b, {", ".join(f"0e0 AS w{i}" for i in k)}
  UNION ALL
  SELECT i + 1, b - eta * sum(g), {moved} FROM (
    SELECT i, b, {w}, {x}, eta, c * (1e0 / (1e0 + exp(-({_LINEAR}))) - y) AS g
    FROM descent, learning WHERE i < {_DESCENTS}) GROUP BY i, b, {w}, eta),
fitted AS MATERIALIZED (SELECT * FROM descent WHERE i = {_DESCENTS})
"""


_LINEAR = "b + " + " + ".join(f"w{i} * x{i}" for i in range(len(_SCALED)))


def _inputs() -> str:
    return ", ".join(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END AS x{i}"
                     for i, c in enumerate(_SCALED))


def _probability(rows: str, columns: str) -> str:
    return (f"SELECT {columns}, CAST(p > 0.5 AS INTEGER) AS prediction, round(p, 3) AS probability_repeat "
            f"FROM (SELECT {columns}, 1e0 / (1e0 + exp(-({_LINEAR}))) AS p "
            f"FROM (SELECT *, {_inputs()} FROM {rows}, learned), fitted)")


def _coefficients() -> str:
    listed = " UNION ALL ".join(f"SELECT '{c}' AS feature, w{i} AS w FROM fitted"
                                for i, c in enumerate(_SCALED))
    return ("SELECT CAST(row_number() OVER (ORDER BY abs(w) DESC, feature) AS INTEGER) AS rank, feature, "
            "round(w, 3) AS coefficient, CASE WHEN w > 0 THEN 'increases' ELSE 'decreases' END AS direction "
            f"FROM ({listed})")


_TEST_ROWS = "(SELECT * FROM stratified WHERE split = 'test')"

_NEW_ORDERS = """(
  SELECT o.order_id, coalesce(CAST(i.order_value AS DOUBLE), v) AS order_value, 0e0 AS was_late,
         CAST(coalesce(p.installments, 1) AS DOUBLE) AS installments, coalesce(r.review_score, m) AS review_score,
         CAST(coalesce(payment_type, 'unknown') = 'credit_card' AS DOUBLE) AS payment_type_credit_card,
         CAST(coalesce(payment_type, 'unknown') = 'debit_card' AS DOUBLE) AS payment_type_debit_card,
         CAST(coalesce(payment_type, 'unknown') = 'unknown' AS DOUBLE) AS payment_type_unknown,
         CAST(coalesce(payment_type, 'unknown') = 'voucher' AS DOUBLE) AS payment_type_voucher
  FROM (SELECT order_id FROM stg_orders WHERE order_status IS DISTINCT FROM 'delivered') o
  LEFT JOIN items_of_order i ON i.order_id = o.order_id
  LEFT JOIN (SELECT order_id, CAST(sum(review_score) AS DOUBLE) / count(*) AS review_score
             FROM stg_reviews GROUP BY order_id) r ON r.order_id = o.order_id
  LEFT JOIN (SELECT * FROM stg_payments QUALIFY row_number() OVER (
               PARTITION BY order_id ORDER BY payment_value DESC NULLS LAST,
               payment_type DESC NULLS LAST, installments DESC NULLS LAST) = 1) p ON p.order_id = o.order_id,
  (SELECT median(order_value) AS v, median(review_score) AS m FROM features))"""


_FIGURES = (
    ("balance", "t_stat", "printf('%.3f', t)"),
    ("balance", "p_value", "printf('%.3f', p_balance)"),
    ("balance", "groups_alike", "CAST(p_balance > 0.05 AS VARCHAR)"),
    ("result", "treatment_rate", "printf('%.4f', treatment_rate)"),
    ("result", "control_rate", "printf('%.4f', control_rate)"),
    ("result", "lift_pp", "printf('%.2f', absolute_lift_pp)"),
    ("result", "z_stat", "printf('%.3f', z_stat)"),
    ("result", "p_value", "printf('%.4f', p_value)"),
    ("decision", "revenue", "printf('%.0f', incremental_revenue)"),
    ("decision", "cost", "printf('%.0f', discount_cost)"),
    ("decision", "ship", "CAST(p_value < 0.05 AND incremental_revenue > discount_cost AS VARCHAR)"),
)


def _report() -> str:
    source = "(SELECT t, p_value AS p_balance FROM ttest), business"
    return " UNION ALL ".join(
        f"SELECT {i} AS line_no, '{section}' AS section, '{name}' AS name, {value} AS value FROM {source}"
        for i, (section, name, value) in enumerate(_FIGURES, 1))


_COUNTS = " UNION ALL ".join(
    f"SELECT '{table}' AS \"table\", count(*) AS n_rows FROM {source}" for table, source in (
        ("customers", "raw_customers"), ("orders", "raw_orders"), ("order_items", "raw_items"),
        ("payments", "raw_payments"), ("reviews", "raw_reviews")))

_STATES = ("SELECT state, CAST(sum(is_repeat_customer) AS DOUBLE) / count(*) * 100 AS repeat_rate_pct "
           "FROM customers_mart WHERE state IS NOT NULL GROUP BY state")

_HISTOGRAM = """
  SELECT CAST(b AS INTEGER) AS bin_no,
         printf('%.0f-%.0f', lo + b * ((hi - lo) / 40e0), lo + (b + 1) * ((hi - lo) / 40e0)) AS bin,
         coalesce(n, 0) AS "count"
  FROM range(40) r(b), bounds
  LEFT JOIN (SELECT least(floor((CAST(order_value AS DOUBLE) - lo) / ((hi - lo) / 40e0)), 39) AS k,
                    count(*) AS n
             FROM orders_mart, bounds WHERE order_value IS NOT NULL GROUP BY k) ON k = b
"""

_KDE = """
  SELECT CAST(g AS INTEGER) AS point_no, round(x, 6) AS x, round(density, 6) AS density FROM (
    SELECT g, lo + g * ((hi - lo) / 199e0) AS x,
           sum(w * exp(-0.5e0 * pow((lo + g * ((hi - lo) / 199e0) - c) / h, 2))
               / (h * sqrt(2e0 * pi())) * (hi - lo) / 40e0) AS density
    FROM range(200) r(g),
         (SELECT floor((v - lo) / least((hi - lo) / 2e3, h / 4e0)) AS cell, count(*) AS w,
                 CAST(sum(order_value) AS DOUBLE) / count(*) AS c
          FROM (SELECT order_value, CAST(order_value AS DOUBLE) AS v FROM orders_mart
                WHERE order_value IS NOT NULL), m GROUP BY cell), m
    GROUP BY g, lo, hi)
"""
_KDE_MOMENTS = """, m AS (
  SELECT min(CAST(order_value AS DOUBLE)) AS lo, max(CAST(order_value AS DOUBLE)) AS hi,
         pow(count(order_value), -0.2e0) * stddev_samp(CAST(order_value AS DOUBLE)) AS h
  FROM orders_mart)
"""

_LIFTS = """
  SELECT k * 5e-1 AS lift_pp, "group", count(*) AS n,
         CAST(sum(CASE WHEN u < least(greatest(
           p + CASE WHEN "group" = 'treatment' THEN (k * 5e-1) / 1e2 ELSE 0e0 END, 0e0), 1e0)
           THEN 1 ELSE 0 END) AS BIGINT) AS successes
  FROM assigned, base, range(21) r(k) GROUP BY k, "group"
"""

_TESTS = """
  SELECT 'fct_orders is not empty' AS test, count(*) AS value, count(*) > 0 AS passed FROM orders_mart
  UNION ALL SELECT 'fct_orders has no negative order_value', count(*), count(*) = 0
            FROM orders_mart WHERE order_value < 0
  UNION ALL SELECT 'fct_customers is not empty', count(*), count(*) > 0 FROM customers_mart
  UNION ALL SELECT 'fct_customers has one row per customer', count(*), count(*) = 0
            FROM (SELECT customer_id FROM customers_mart GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'int_order_economics has unique order_id', count(*), count(*) = 0
            FROM (SELECT order_id FROM economics GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'payment flags add up to the raw payments', a - b, a = b
            FROM (SELECT count(*) AS a FROM stg_payments), (SELECT count(*) AS b FROM raw_payments)
  UNION ALL SELECT 'experiment groups add up to all customers', a - b, a = b
            FROM (SELECT count("group") AS a FROM assigned), (SELECT count(*) AS b FROM customers_mart)
"""

_ORDER_GRAIN = """
  SELECT e.order_id, e.customer_id, CAST(e.order_value AS DOUBLE) AS order_value, e.was_late,
         r.review_score, p.payment_type, p.installments, p.payment_quality_flag, s.order_seq_num,
         CASE WHEN s.order_seq_num > 1 THEN 1 ELSE 0 END AS is_repeat_order
  FROM economics e JOIN sequence s ON s.order_id = e.order_id
  LEFT JOIN (SELECT order_id, CAST(sum(review_score) AS DOUBLE) / count(*) AS review_score
             FROM stg_reviews GROUP BY order_id) r ON r.order_id = e.order_id
  LEFT JOIN (SELECT * FROM stg_payments QUALIFY row_number() OVER (
               PARTITION BY order_id ORDER BY payment_value DESC NULLS LAST,
               payment_type DESC NULLS LAST, installments DESC NULLS LAST) = 1) p
    ON p.order_id = e.order_id
"""

_CLASSES = """
  SELECT "class", round("precision", 9) AS "precision", round(recall, 9) AS recall,
         round(f1_score, 9) AS f1_score, support FROM (
    SELECT 'not_repeat' AS "class", tn / CAST(tn + fn AS DOUBLE) AS "precision",
           tn / CAST(tn + fp AS DOUBLE) AS recall, 2 * tn / CAST(2 * tn + fn + fp AS DOUBLE) AS f1_score,
           tn + fp AS support FROM matrix
    UNION ALL SELECT 'repeat', tp / CAST(tp + fp AS DOUBLE), tp / CAST(tp + fn AS DOUBLE),
           2 * tp / CAST(2 * tp + fn + fp AS DOUBLE), tp + fn FROM matrix
    UNION ALL SELECT 'accuracy', a, a, a, n FROM (
           SELECT (tn + tp) / CAST(tn + fp + fn + tp AS DOUBLE) AS a, tn + fp + fn + tp AS n FROM matrix)
    UNION ALL SELECT 'macro avg', (tn / CAST(tn + fn AS DOUBLE) + tp / CAST(tp + fp AS DOUBLE)) / 2,
           (tn / CAST(tn + fp AS DOUBLE) + tp / CAST(tp + fn AS DOUBLE)) / 2,
           (2 * tn / CAST(2 * tn + fn + fp AS DOUBLE) + 2 * tp / CAST(2 * tp + fn + fp AS DOUBLE)) / 2,
           tn + fp + fn + tp FROM matrix
    UNION ALL SELECT 'weighted avg',
           (tn / CAST(tn + fn AS DOUBLE) * (tn + fp) + tp / CAST(tp + fp AS DOUBLE) * (tp + fn)) / (tn + fp + fn + tp),
           CAST(tn + tp AS DOUBLE) / (tn + fp + fn + tp),
           (2 * tn / CAST(2 * tn + fn + fp AS DOUBLE) * (tn + fp)
            + 2 * tp / CAST(2 * tp + fn + fp AS DOUBLE) * (tp + fn)) / (tn + fp + fn + tp),
           tn + fp + fn + tp FROM matrix)
"""

_AUC = """
  SELECT round(sum(pos * (below + neg / 2e0)) / (sum(pos) * sum(neg)), 9) AS roc_auc FROM (
    SELECT pos, neg, sum(neg) OVER (ORDER BY score) - neg AS below FROM (
      SELECT score, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg
      FROM test_scores GROUP BY score))
"""

BODIES: dict[str, str] = {
    "stg_customers": "SELECT * FROM stg_customers",
    "stg_orders": "SELECT * FROM stg_orders",
    "stg_order_items": "SELECT order_id, item_no, product_id, seller_id, category, "
                       "CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value "
                       "FROM raw_items",
    "stg_payments": "SELECT * FROM stg_payments",
    "stg_reviews": "SELECT * FROM stg_reviews",
    "item_agg": "SELECT order_id, n_items, CAST(merchandise_value AS DOUBLE) AS merchandise_value, "
                "CAST(freight_value AS DOUBLE) AS freight_value, CAST(order_value AS DOUBLE) AS order_value "
                "FROM items_of_order",
    "int_order_economics": "SELECT * REPLACE (CAST(merchandise_value AS DOUBLE) AS merchandise_value, "
                           "CAST(freight_value AS DOUBLE) AS freight_value, "
                           "CAST(order_value AS DOUBLE) AS order_value) FROM economics",
    "int_order_review": "SELECT * EXCLUDE (payment_value) REPLACE (CAST(order_value AS DOUBLE) "
                        "AS order_value) FROM order_review",
    "int_customer_order_sequence": "SELECT * REPLACE (CAST(order_value AS DOUBLE) AS order_value) FROM sequence",
    "fct_customers": "SELECT * FROM customers_mart",
    "fct_orders": "SELECT * REPLACE (CAST(order_value AS DOUBLE) AS order_value) FROM orders_mart",
    "fct_orders_order_grain": _ORDER_GRAIN,
    "late_vs_repeat": "SELECT was_late, count(DISTINCT customer_id) AS customers, "
                      "((2000 * sum(is_repeat_order) + count(*)) // (2 * count(*))) / 1e1 AS repeat_rate_pct, "
                      "((200 * sum(review_score) + count(review_score)) // (2 * count(review_score))) / 1e2 "
                      "AS avg_review_score FROM orders_mart GROUP BY was_late",
    "payment_quality_counts": "SELECT payment_quality_flag, count(*) AS n_payments FROM stg_payments GROUP BY 1",
    "data_tests": _TESTS,
    "amount_quality": " UNION ALL ".join(
        f"SELECT '{table}.{column}' AS amount, count(*) AS n_rows, count(*) - count({column}) AS n_missing, "
        f"count(CASE WHEN NOT isfinite(CAST({column} AS DOUBLE)) THEN 1 END) AS n_not_finite, "
        f"count(CASE WHEN round(CAST({column} AS DOUBLE) * 10000) / 10000 <> {column} THEN 1 END) AS n_fine, "
        f"count(CASE WHEN NOT isfinite(CAST({column} AS DOUBLE)) THEN 1 END) = 0 AS passed FROM {rows}"
        for table, column, rows in (("order_items", "price", "raw_items"), ("order_items", "freight_value", "raw_items"),
                                    ("payments", "payment_value", "raw_payments"))),
    "table_counts": _COUNTS,
    "validate_schema": f"SELECT \"table\", '' AS missing_required, '' AS missing_needed_by_view, n_rows "
                       f"FROM ({_COUNTS})",
    "validate_schema_missing":
        "SELECT \"table\", CASE \"table\" WHEN 'payments' THEN 'payment_value' WHEN 'reviews' THEN '*' "
        "ELSE '' END AS missing_required, CASE \"table\" WHEN 'orders' THEN 'delivered_ts' ELSE '' END "
        "AS missing_needed_by_view, CASE \"table\" WHEN 'reviews' THEN 0 ELSE n_rows END AS n_rows "
        f"FROM ({_COUNTS})",
    "csv_orders": "SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id, "
                  "CAST(customer_id AS VARCHAR) AS customer_id) FROM stg_orders",
    "market_payments": "SELECT CAST(order_id AS VARCHAR) AS order_id, payment_type, installments, "
                       "payment_value FROM raw_payments",
    "market_reviews": "SELECT CAST(order_id AS VARCHAR) AS order_id, review_score FROM raw_reviews",
    "market_customers": "SELECT CAST(customer_unique_id AS VARCHAR) AS customer_id, customer_city AS city, "
                        "customer_state AS state FROM market_customers QUALIFY row_number() OVER "
                        "(PARTITION BY customer_unique_id ORDER BY customer_id) = 1",
    "order_value_sketch": "SELECT CAST(share AS DOUBLE) AS share, count(order_value) AS n, true AS within "
                          "FROM economics, (VALUES (0.01), (0.1), (0.25), (0.5), (0.75), (0.9), (0.99)) q(share) GROUP BY share",
    "late_and_on_time": "SELECT state, CAST(sum(late) AS BIGINT) AS n_late, CAST(sum(on_time) AS BIGINT) AS n_on_time, "
                        "CAST(sum(late * on_time) AS BIGINT) AS n_both, count(*) AS n_either FROM ("
                        "SELECT c.state, c.customer_id, max(was_late) AS late, max(1 - was_late) AS on_time "
                        "FROM economics e JOIN stg_customers c ON c.customer_id = e.customer_id GROUP BY 1, 2) GROUP BY state",
    "csv_types": " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{column}' AS \"column\", CASE WHEN k = 4 THEN 'timestamp_ntz' "
        "WHEN k = 0 OR k & 12 <> 0 THEN 'string' WHEN k & 2 <> 0 THEN 'double' ELSE 'bigint' END AS type FROM ("
        "SELECT coalesce(bit_or(CASE WHEN v IS NULL THEN 0 WHEN regexp_full_match(v, '[+-]?[0-9]{1,18}') THEN 1 "
        "WHEN regexp_full_match(v, '[+-]?[0-9]{19,}') THEN 8 "
        "WHEN regexp_full_match(v, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN 2 "
        "WHEN regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\\.[0-9]{1,6})?)?)?') "
        "AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL THEN 4 ELSE 8 END), 0) AS k "
        f"FROM (SELECT CAST({column} AS VARCHAR) AS v FROM {rows}))"
        for table, rows in (("customers", "raw_customers"), ("orders", "raw_orders"), ("order_items", "raw_items"),
                            ("payments", "raw_payments"), ("reviews", "raw_reviews"))
        for column in RAW_TABLES[table].names),
    "preview_customers": "SELECT * FROM customers_mart ORDER BY customer_id, state, lifetime_order_count LIMIT 5",
    "eda_metrics": "SELECT (SELECT CAST(sum(order_value) AS DOUBLE) FROM orders_mart) AS total_revenue, "
                   "(SELECT CAST(sum(is_repeat_customer) AS DOUBLE) / count(*) * 100 FROM customers_mart) "
                   "AS repeat_rate, (SELECT CAST(sum(was_late) AS DOUBLE) / count(*) * 100 FROM orders_mart) "
                   "AS late_rate",
    "order_histogram": _HISTOGRAM,
    "order_value_kde": _KDE_MOMENTS + _KDE,
    "repeat_by_state": _STATES,
    "repeat_by_state_top15": f"SELECT * FROM ({_STATES}) ORDER BY repeat_rate_pct DESC, state LIMIT 15",
    "review_by_delivery": "SELECT CASE was_late WHEN 1 THEN 'Late' ELSE 'On time' END AS delivery, "
                          "CAST(sum(review_score) AS DOUBLE) / count(*) AS avg_review_score "
                          "FROM orders_mart WHERE review_score IS NOT NULL GROUP BY 1",
    "identity_map": "SELECT DISTINCT customer_id, customer_unique_id FROM market_customers",
    "dedup_customers": "SELECT customer_unique_id AS customer_id, customer_city AS city, customer_state AS state "
                       "FROM market_customers QUALIFY row_number() OVER (PARTITION BY customer_unique_id "
                       "ORDER BY customer_id) = 1",
    "rekey_orders": "SELECT o.order_id, m.customer_unique_id AS customer_id, o.order_status, o.purchase_ts, "
                    "o.approved_ts, o.estimated_delivery_ts, o.delivered_ts FROM order_rows o "
                    "JOIN (SELECT DISTINCT customer_id, customer_unique_id FROM market_customers) m "
                    "ON m.customer_id = o.order_id",
    "item_category": "SELECT i.order_id, i.item_no, i.product_id, i.seller_id, "
                     "coalesce(p.english, p.name, 'other') AS category, CAST(i.price AS DOUBLE) AS price, "
                     "CAST(i.freight_value AS DOUBLE) AS freight_value FROM raw_items i "
                     "LEFT JOIN (SELECT product_id, name, CASE WHEN name IS NOT NULL THEN english END AS english "
                     "FROM market_products) p ON p.product_id = i.product_id",
    "ab_assignment": "SELECT customer_id, \"group\" FROM assigned",
    "ab_outcome": "SELECT customer_id, \"group\", outcome FROM outcome",
    "ab_balance": "SELECT n_control, n_treatment, round(mean_control, 6) AS mean_control, "
                  "round(mean_treatment, 6) AS mean_treatment, round(t, 6) AS t_stat, "
                  "round(p_value, 6) AS p_value, p_value > 0.05 AS balanced FROM ttest",
    "ab_counts": "SELECT \"group\", count(*) AS n, CAST(sum(outcome) AS BIGINT) AS successes "
                 "FROM outcome GROUP BY 1",
    "ab_ztest": "SELECT treatment_rate, control_rate, absolute_lift_pp, round(z_stat, 6) AS z_stat, "
                "round(p_value, 6) AS p_value FROM ztest",
    "ab_business": "SELECT treatment_rate, control_rate, absolute_lift_pp, round(z_stat, 6) AS z_stat, "
                   "round(p_value, 6) AS p_value, round(incremental_revenue, 6) AS incremental_revenue, "
                   "round(discount_cost, 6) AS discount_cost, p_value < 0.05 AND "
                   "incremental_revenue > discount_cost AS recommend_ship FROM business",
    "ab_lift_sweep": _LIFTS,
    "ab_report": _report(),
    "first_order_features": "SELECT * FROM features",
    "features_imputed": "SELECT * FROM imputed",
    "features_onehot": "SELECT * FROM onehot",
    "split_train_test": "SELECT order_id, customer_id, is_repeat_customer, split FROM splitted",
    "split_stratified": "SELECT order_id, customer_id, is_repeat_customer, split FROM stratified",
    "features_scaled": _scaled(),
    "confusion_matrix": "SELECT tn, fp, fn, tp FROM matrix",
    "classification_report": _CLASSES,
    "roc_auc": _AUC,
}



def _number(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(38,6)) AS VARCHAR)"


BODIES["eda_json"] = f"""
  SELECT 'metrics' AS section, concat('{{"total_revenue":', {_number('total_revenue')}, ',"repeat_rate":',
         {_number('repeat_rate')}, ',"late_rate":', {_number('late_rate')}, '}}') AS record
  FROM ({BODIES["eda_metrics"]})
  UNION ALL SELECT 'order_distribution', concat('{{"bin":"', bin, '","count":', "count", '}}')
  FROM ({_HISTOGRAM})
  UNION ALL SELECT 'repeat_rate_by_state', concat('{{"state":"', state, '","repeat_rate_pct":',
         {_number('repeat_rate_pct')}, '}}') FROM ({_STATES})
  UNION ALL SELECT 'review_by_delivery', concat('{{"delivery":"', delivery, '","avg_review_score":',
         {_number('avg_review_score')}, '}}') FROM ({BODIES["review_by_delivery"]})
"""

MODELS: dict[str, str] = {
    "lr_coefficients": _coefficients(),
    "lr_scores": _probability(_TEST_ROWS, "order_id, customer_id, is_repeat_customer"),
    "score_new_orders": _probability(_NEW_ORDERS, "order_id"),
    "lr_report": _CLASSES.replace("FROM matrix", f"""FROM (
      SELECT count(*) FILTER (y = 0 AND prediction = 0) AS tn, count(*) FILTER (y = 0 AND prediction = 1) AS fp,
             count(*) FILTER (y = 1 AND prediction = 0) AS fn, count(*) FILTER (y = 1 AND prediction = 1) AS tp
      FROM (SELECT is_repeat_customer AS y, prediction FROM (
        {_probability(_TEST_ROWS, "is_repeat_customer")})))"""),
}


def with_views(body: str, *parts: str) -> str:
    return "WITH " + ",".join(parts) + body


ORACLES: dict[str, str] = {
    name: with_views(body, RAW, MARKET, DERIVED) for name, body in BODIES.items()}
ORACLES |= {name: with_views(_fitted() + body, " RECURSIVE " + RAW, MARKET, DERIVED)
            for name, body in MODELS.items()}
