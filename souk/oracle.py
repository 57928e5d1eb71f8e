"""DuckDB SQL for every registered query, used as the correctness oracle.

Each statement starts with ``PRELUDE``: the driver -> marketplace mapping of
``souk.sources.driver`` (``b_<table>``), the padding and duplicate rows it adds
(``r_<table>``) and the cleaning (``w_<table>``).  The statements compute each
result on another route than the builders where there is one: pre-aggregated
per key, filtered aggregates, totals from scalar queries, buckets from row
numbers, money in integer units.
"""

from __future__ import annotations

import math

from souk.functions import dist
from souk.plans import payments, rfm, sales, stats, views
from souk.sources.schemas import DATE_RANGE_CHECKS, KEY_CHECKS, LOAD_ORDER, TABLES

_BASE = """
WITH
li AS (
    SELECT l.*,
           ROW_NUMBER() OVER (PARTITION BY l_orderkey
                              ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS item_no
    FROM lineitem l
),
b_orders AS (
    SELECT o.o_orderkey AS order_id,
           o.o_custkey AS customer_id,
           CASE o.o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                                WHEN 'P' THEN 'processing' ELSE 'unavailable' END AS order_status,
           o.o_orderdate AS order_purchase_timestamp,
           CASE WHEN o.o_orderstatus <> 'P' THEN o.o_orderdate + INTERVAL 6 HOUR END AS order_approved_at,
           s.first_ship AS order_delivered_carrier_date,
           s.last_ship AS order_delivered_customer_date,
           o.o_orderdate + INTERVAL 1080 DAY + INTERVAL 12 HOUR AS order_estimated_delivery_date
    FROM orders o LEFT JOIN (SELECT l_orderkey, MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship FROM lineitem GROUP BY ALL) s
         ON s.l_orderkey = o.o_orderkey
),
b_customers AS (
    SELECT c.c_custkey AS customer_id,
           c.c_name AS customer_unique_id,
           lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
           lower(c.c_mktsegment) AS customer_city,
           n.n_name AS customer_state
    FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
),
b_sellers AS (
    SELECT s.s_suppkey AS seller_id,
           lpad(CAST(s.s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
           lower(s.s_name) AS seller_city,
           n.n_name AS seller_state
    FROM supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
),
b_geolocation AS (
    SELECT lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
           c.c_acctbal / 1000.0 AS geolocation_lat,
           CAST(c.c_custkey % 997 AS DOUBLE) / -10.0 AS geolocation_lng,
           lower(c.c_mktsegment) AS geolocation_city,
           n.n_name AS geolocation_state
    FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
),
b_translation AS (
    SELECT DISTINCT p_brand AS product_category_name,
           lower(replace(p_brand, '#', '_')) AS product_category_name_english
    FROM part
    WHERE TRY_CAST(split_part(p_brand, '#', -1) AS INTEGER) % 3 <> 0
),
b_products AS (
    SELECT p.p_partkey AS product_id,
           p.p_brand AS product_category_name,
           length(p.p_name) AS product_name_lenght,
           length(p.p_type) AS product_description_lenght,
           (p.p_size % 5) + 1 AS product_photos_qty,
           p.p_retailprice AS product_weight_g,
           CAST(p.p_size AS DOUBLE) AS product_length_cm,
           p.p_size / 2.0 AS product_height_cm,
           p.p_size / 4.0 AS product_width_cm
    FROM part p
),
b_items AS (
    SELECT l_orderkey AS order_id, CAST(item_no AS INTEGER) AS order_item_id, l_partkey AS product_id,
           l_suppkey AS seller_id, l_shipdate AS shipping_limit_date, l_extendedprice AS price,
           l_extendedprice * l_tax AS freight_value
    FROM li
),
b_payments AS (
    SELECT l_orderkey AS order_id, CAST(item_no AS INTEGER) AS payment_sequential,
           CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto'
                             WHEN 'R' THEN 'voucher' ELSE 'not_defined' END AS payment_type,
           l_linenumber AS payment_installments,
           l_extendedprice AS payment_value
    FROM li
),
b_reviews AS (
    SELECT 'rv' || CAST(o_orderkey AS VARCHAR) AS review_id,
           o_orderkey AS order_id,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS review_score,
           CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 2 THEN o_orderpriority END
               AS review_comment_title,
           CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) <= 3 THEN 'priority ' || o_orderpriority END
               AS review_comment_message,
           o_orderdate + INTERVAL 1081 DAY AS review_creation_date,
           o_orderdate + INTERVAL 1081 DAY + INTERVAL 30 HOUR AS review_answer_timestamp
    FROM orders
)
"""

_BLANKS = "' ' || chr(9)"


def _as_delivered(table: str, number: str | None, texts: tuple[str, ...]) -> str:
    """r_<table>: rows whose number ends in 3 or 7 twice, texts padded for 0, 5 and the second 7."""
    if number is None:
        return f"r_{table} AS (SELECT * FROM b_{table})"
    pad = "d IN (0, 5) OR (d = 7 AND k = 1)"
    changed = ", ".join(f"CASE WHEN {pad} THEN '  ' || {c} || chr(9) ELSE {c} END AS {c}" for c in texts)
    return (
        f"r_{table} AS (SELECT * EXCLUDE (d, k)" + (f" REPLACE ({changed})" if texts else "") + " FROM "
        f"(SELECT *, {number} % 10 AS d FROM b_{table}) JOIN (VALUES (0), (1)) v(k) ON k = 0 OR d IN (3, 7))"
    )


def _cleaned(table: str, texts: tuple[str, ...], name: str | None = None) -> str:
    """Distinct rows of r_<table> after trimming."""
    changed = ", ".join(f"trim({c}, {_BLANKS}) AS {c}" for c in texts)
    return f"{name or 'w_' + table} AS (SELECT DISTINCT *" + (f" REPLACE ({changed})" if texts else "") + f" FROM r_{table})"


# table, the number its rows go by, and the padded text columns
_DIRT = {
    "translation": ("CAST(split_part(product_category_name, '#', -1) AS INTEGER)", ("product_category_name_english",)),
    "customers": ("customer_id", ("customer_unique_id", "customer_city")),
    "sellers": ("seller_id", ("seller_city",)),
    "geolocation": (None, ()),
    "products": ("product_id", ("product_category_name",)),
    "orders": ("order_id", ("order_status",)),
    "items": ("order_id", ()),
    "payments": ("order_id", ("payment_type",)),
    "reviews": ("order_id", ("review_comment_title", "review_comment_message")),
}
_DERIVED = """
w_translation AS (
    SELECT * FROM c_translation
    UNION ALL
    SELECT DISTINCT p.product_category_name, p.product_category_name FROM c_products p
    ANTI JOIN c_translation t ON t.product_category_name = p.product_category_name
    WHERE p.product_category_name IS NOT NULL
),
w_products AS (
    SELECT p.*, (SELECT any_value(t.product_category_name_english) FROM w_translation t
                 WHERE t.product_category_name = p.product_category_name) AS product_category_name_english
    FROM c_products p
),
w_orders AS (
    SELECT c.*, strftime(order_purchase_timestamp, '%Y-%m') AS order_purchase_month,
           CAST(FLOOR(date_diff('microsecond', order_estimated_delivery_date, order_delivered_customer_date)
                      / 86400000000.0) AS INTEGER) AS delivery_delay_days
    FROM c_orders c
),
"""
PRELUDE = (
    _BASE.rstrip()
    + ",\n"
    + ",\n".join(_as_delivered(t, n, c) for t, (n, c) in _DIRT.items())
    + ",\n"
    + ",\n".join(_cleaned(t, c, f"c_{t}" if t in ("translation", "products", "orders") else None) for t, (_, c) in _DIRT.items())
    + ","
    + _DERIVED
)


# ---------------------------------------------------------------------------
# Money: exact sums as integers of 1e-10, rounded half away from zero
# ---------------------------------------------------------------------------


def _units(value: str) -> str:
    return f"CAST(replace(CAST(SUM(CAST({value} AS DECIMAL(22, 10))) AS VARCHAR), '.', '') AS HUGEINT)"


def _per(units: str, n: str) -> str:
    """units / n in money with two decimals."""
    cent = f"(100000000 * CAST({n} AS HUGEINT))"
    return f"CAST(sign({units}) * ((2 * abs({units}) + {cent}) // (2 * {cent})) AS DOUBLE) / 100"


_PAID = f"""
paid AS (SELECT order_id, {_units("payment_value")} AS units, SUM(payment_value) AS amount FROM w_payments GROUP BY order_id),
sold AS (SELECT o.*, units, amount FROM w_orders o JOIN paid USING (order_id) WHERE order_status = 'delivered')
"""

M01 = PRELUDE + _PAID + f"""
SELECT order_purchase_month, COUNT(*) AS order_count, {_per("SUM(units)", "1")} AS total_revenue,
       {_per("SUM(units)", "COUNT(*)")} AS avg_order_value
FROM sold GROUP BY ALL ORDER BY 1
"""

M03 = PRELUDE + _PAID + f""",
buyer AS (SELECT customer_id, COUNT(*) AS orders, SUM(units) AS units FROM sold GROUP BY customer_id),
place AS (SELECT customer_state, CAST(SUM(orders) AS BIGINT) AS order_count, SUM(buyer.units) AS units
          FROM w_customers JOIN buyer USING (customer_id) GROUP BY customer_state)
SELECT customer_state, order_count, {_per("units", "1")} AS total_revenue, {_per("units", "order_count")} AS avg_order_value
FROM place ORDER BY total_revenue DESC, customer_state
"""

_CATEGORY = PRELUDE + _PAID + """,
part_of AS (SELECT order_id, product_id, SUM(price) AS price, COUNT(*) AS lines FROM w_items GROUP BY ALL),
whole AS (SELECT order_id, SUM(price) AS price FROM part_of GROUP BY order_id),
per_product AS (
    SELECT product_id, SUM(part_of.price * (amount / NULLIF(whole.price, 0))) AS revenue, SUM(lines) AS lines
    FROM part_of JOIN whole USING (order_id) JOIN sold USING (order_id) GROUP BY product_id
),
per_category AS (
    SELECT COALESCE((SELECT any_value(p.product_category_name_english) FROM w_products p
                     WHERE p.product_id = per_product.product_id), 'unknown') AS category, revenue, lines
    FROM per_product
),
category_sums AS (
    SELECT category, ROUND(SUM(revenue), 2) AS total_revenue, CAST(SUM(lines) AS BIGINT) AS line_items FROM per_category GROUP BY category
),
best AS (SELECT * FROM category_sums ORDER BY total_revenue DESC, category LIMIT """ + str(sales.CATEGORY_TOP_K) + """)
"""
M02 = _CATEGORY + "SELECT * FROM best ORDER BY total_revenue DESC, category"


# ---------------------------------------------------------------------------
# Recency, frequency, money
# ---------------------------------------------------------------------------


def _fifth(rn: str) -> str:
    """Bucket of five from a row number and the number of rows n: the first n % 5 buckets hold one more."""
    return f"CASE WHEN {rn} <= (n % 5) * (n // 5 + 1) THEN ({rn} - 1) // (n // 5 + 1) + 1 ELSE ({rn} - 1 - n % 5) // greatest(n // 5, 1) + 1 END"


def _segment() -> str:
    tests = {name: " AND ".join(f"{c}_score {op} {bound}" for c, op, bound in rule) for name, rule in rfm.SEGMENT_RULES}
    return "CASE " + " ".join(f"WHEN {t} THEN '{name}'" for name, t in tests.items()) + f" ELSE '{rfm.DEFAULT_SEGMENT}' END"


_SCORES = PRELUDE + _PAID + f""",
person AS (
    SELECT customer_unique_id, MAX(CAST(order_purchase_timestamp AS DATE)) AS last_day, COUNT(*) AS frequency, SUM(units) AS units
    FROM sold JOIN w_customers USING (customer_id) GROUP BY customer_unique_id
),
numbered AS (
    SELECT *, (SELECT COUNT(*) FROM person) AS n, (SELECT MAX(last_day) FROM person) AS today,
           ROW_NUMBER() OVER (ORDER BY last_day, customer_unique_id) AS by_day,
           ROW_NUMBER() OVER (ORDER BY frequency, customer_unique_id) AS by_count,
           ROW_NUMBER() OVER (ORDER BY units, customer_unique_id) AS by_money
    FROM person
),
fifths AS (
    SELECT customer_unique_id, CAST(today - last_day AS BIGINT) AS recency_days, frequency, units,
           CAST({_fifth("by_day")} AS BIGINT) AS r_score, CAST({_fifth("by_count")} AS BIGINT) AS f_score,
           CAST({_fifth("by_money")} AS BIGINT) AS m_score
    FROM numbered
),
labelled AS (SELECT *, {_segment()} AS segment FROM fifths)
"""
M04 = _SCORES + f"""
SELECT customer_unique_id, recency_days, frequency, {_per("units", "1")} AS monetary, r_score, f_score, m_score,
       r_score + f_score + m_score AS rfm_score, segment
FROM labelled
"""
W5 = _SCORES + "SELECT customer_unique_id, r_score, f_score, m_score FROM fifths"
M05 = _SCORES + f"""
SELECT segment, COUNT(*) AS customer_count, {_per("SUM(units)", "1")} AS total_revenue,
       {_per("SUM(units)", "COUNT(*)")} AS avg_revenue_per_customer
FROM labelled GROUP BY segment ORDER BY total_revenue DESC, segment
"""

# ---------------------------------------------------------------------------
# Cohorts
# ---------------------------------------------------------------------------

_MONTHS = PRELUDE + """
visit AS (
    SELECT customer_unique_id AS person, year(order_purchase_timestamp) * 12 + month(order_purchase_timestamp) - 1 AS m
    FROM w_customers JOIN w_orders USING (customer_id) WHERE order_status = 'delivered' GROUP BY ALL
),
shifted AS (SELECT person, MIN(m) OVER (PARTITION BY person) AS m0, m - MIN(m) OVER (PARTITION BY person) AS later FROM visit),
cell AS (SELECT m0, later, COUNT(*) AS people FROM shifted GROUP BY m0, later)
"""
_MONTH_OF = "CAST(make_date(m0 // 12, m0 % 12 + 1, 1) AS TIMESTAMP)"
M06 = _MONTHS + f"""
SELECT {_MONTH_OF} AS cohort_month, later AS months_since_first, people AS active_customers,
       first_value(people) OVER (PARTITION BY m0 ORDER BY later) AS cohort_size,
       ROUND(100.0 * people / first_value(people) OVER (PARTITION BY m0 ORDER BY later), 2) AS retention_pct
FROM cell ORDER BY 1, 2
"""
M07 = _MONTHS + f"SELECT {_MONTH_OF} AS cohort_month, people AS cohort_size FROM cell WHERE later = 0 ORDER BY 1"

# ---------------------------------------------------------------------------
# Delivery
# ---------------------------------------------------------------------------

_ARRIVED = PRELUDE + """
arrived AS (
    SELECT order_id, customer_id, delivery_delay_days AS delay, COALESCE(delivery_delay_days > 0, FALSE) AS is_late
    FROM w_orders WHERE order_delivered_customer_date IS NOT NULL AND order_status = 'delivered'
)
"""
_STATUS = "if(is_late, 'late', 'on_time') AS delivery_status"
M08 = _ARRIVED + f"""
SELECT {_STATUS}, COUNT(*) AS order_count, ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM arrived), 2) AS pct_of_orders,
       ROUND(SUM(delay) / COUNT(delay), 2) AS avg_delay_days
FROM arrived GROUP BY is_late ORDER BY 1
"""
M09 = _ARRIVED + """,
per_buyer AS (
    SELECT customer_id, COUNT(*) AS orders, COUNT(*) FILTER (is_late) AS late, SUM(delay) AS days, COUNT(delay) AS known
    FROM arrived GROUP BY customer_id
)
SELECT customer_state, CAST(SUM(orders) AS BIGINT) AS order_count, ROUND(SUM(days) / SUM(known), 2) AS avg_delay_days,
       ROUND(100.0 * SUM(late) / SUM(orders), 2) AS late_pct
FROM per_buyer JOIN w_customers USING (customer_id) GROUP BY customer_state ORDER BY late_pct DESC, customer_state
"""
M10 = _ARRIVED + f""",
judged AS (
    SELECT order_id, COUNT(*) AS reviews, SUM(review_score) AS points, COUNT(review_score) AS scored,
           COUNT(*) FILTER (review_score < 3) AS bad
    FROM w_reviews GROUP BY order_id
)
SELECT {_STATUS}, CAST(SUM(reviews) AS BIGINT) AS review_count, ROUND(SUM(points) / SUM(scored), 2) AS avg_review_score,
       ROUND(100.0 * SUM(bad) / SUM(reviews), 2) AS pct_bad_reviews
FROM judged JOIN arrived USING (order_id) GROUP BY is_late ORDER BY 1
"""

# ---------------------------------------------------------------------------
# Payments
# ---------------------------------------------------------------------------

_KINDS = PRELUDE + """
kind AS (
    SELECT payment_type, payment_installments, COUNT(*) AS n, SUM(payment_value) AS amount, """ + _units("payment_value") + """ AS units
    FROM w_payments GROUP BY payment_type, payment_installments
),
everything AS (SELECT SUM(n) AS n, SUM(amount) AS amount FROM kind)
"""
M11 = _KINDS + """
SELECT payment_type, CAST(SUM(n) AS BIGINT) AS payment_count, ROUND(100.0 * SUM(n) / (SELECT n FROM everything), 2) AS pct_of_payments,
       ROUND(SUM(amount), 2) AS total_revenue, ROUND(100.0 * SUM(amount) / (SELECT amount FROM everything), 2) AS pct_of_revenue
FROM kind GROUP BY payment_type ORDER BY total_revenue DESC, payment_type
"""
M12 = _KINDS + """
SELECT payment_installments, CAST(SUM(n) AS BIGINT) AS payment_count,
       ROUND(100.0 * SUM(n) / (SELECT n FROM everything), 2) AS pct_of_payments, ROUND(SUM(amount), 2) AS total_revenue
FROM kind GROUP BY payment_installments ORDER BY payment_installments
"""
M13 = _KINDS + f"""
SELECT payment_installments, n AS payment_count, {_per("units", "n")} AS avg_payment_value
FROM kind WHERE payment_type = 'credit_card' ORDER BY payment_installments
"""


def _card_categories(at_least: int) -> str:
    return PRELUDE + f"""
card AS (
    SELECT order_id, COUNT(*) AS n, SUM(payment_installments) AS parts, {_units("payment_value")} AS units
    FROM w_payments WHERE payment_type = 'credit_card' GROUP BY order_id
),
dearest AS (SELECT order_id, first(product_id ORDER BY price DESC, order_item_id) AS product_id FROM w_items GROUP BY order_id),
bought AS (SELECT product_id, SUM(n) AS n, SUM(parts) AS parts, SUM(units) AS units FROM card JOIN dearest USING (order_id) GROUP BY product_id),
summed AS (
    SELECT COALESCE(product_category_name_english, 'unknown') AS category, CAST(SUM(n) AS BIGINT) AS payment_count,
           ROUND(SUM(parts) / SUM(n), 2) AS avg_installments, {_per("SUM(units)", "SUM(n)")} AS avg_payment_value
    FROM bought LEFT JOIN w_products USING (product_id) GROUP BY category
),
shown AS (
    SELECT * FROM summed WHERE payment_count >= {at_least} ORDER BY avg_installments DESC, category LIMIT {payments.CATEGORY_TOP_K}
)
"""


M14 = _card_categories(payments.MIN_CATEGORY_PAYMENTS) + "SELECT * FROM shown ORDER BY avg_installments DESC, category"
A9 = _card_categories(800) + "SELECT * FROM shown ORDER BY avg_installments DESC, category"

M15 = PRELUDE + _PAID + f"""
SELECT {_per("SUM(units)", "1")} AS total_revenue, COUNT(*) AS total_orders, {_per("SUM(units)", "COUNT(*)")} AS avg_order_value,
       (SELECT ROUND(SUM(review_score) / COUNT(review_score), 2) FROM w_reviews
        SEMI JOIN (SELECT order_id FROM w_orders WHERE order_status = 'delivered') d USING (order_id)) AS avg_review_score
FROM sold
"""

# ---------------------------------------------------------------------------
# Exploration
# ---------------------------------------------------------------------------

CTE = {
    "product_category_translation": "w_translation",
    "customers": "w_customers",
    "sellers": "w_sellers",
    "geolocation": "w_geolocation",
    "products": "w_products",
    "orders": "w_orders",
    "order_items": "w_items",
    "order_payments": "w_payments",
    "order_reviews": "w_reviews",
}
# a statement that needs no CTE of its own ends the prelude's list
Q = PRELUDE.rstrip().rstrip(",") + "\n"


def _each(tables, select) -> str:
    return "\nUNION ALL\n".join(select(t) for t in tables)


def _title(expr: str) -> str:
    words = f"string_split(replace({expr}, '_', ' '), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), ' ')"


def _lacking(table: str, columns: dict[str, str], total: str) -> str:
    figures = ", ".join(f"COUNT(*) - COUNT({c}) AS {name}" for name, c in columns.items())
    return Q + f"SELECT {figures}, COUNT(*) AS {total} FROM {table}"


E1 = Q + _each(LOAD_ORDER, lambda t: f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {CTE[t]}") + "\nORDER BY row_count DESC, table_name"
E2 = _lacking(
    "w_orders",
    {
        "missing_approved_at": "order_approved_at",
        "missing_carrier_date": "order_delivered_carrier_date",
        "missing_delivered_date": "order_delivered_customer_date",
        "missing_delivery_delay": "delivery_delay_days",
    },
    "total_orders",
)
E4 = _lacking("w_reviews", {"missing_title": "review_comment_title", "missing_message": "review_comment_message"}, "total_reviews")
E5 = _lacking("w_products", {"missing_category": "product_category_name", "missing_weight": "product_weight_g"}, "total_products")


def _funnel(only: str) -> str:
    """Distinct statuses, each with its number of orders from a correlated count."""
    return PRELUDE + f"""
chosen AS (SELECT order_status FROM w_orders WHERE {only}),
status AS (SELECT DISTINCT order_status FROM chosen)
SELECT order_status, (SELECT COUNT(*) FROM chosen c WHERE c.order_status IS NOT DISTINCT FROM status.order_status) AS n_orders
FROM status ORDER BY n_orders DESC, order_status
"""


E3 = _funnel("order_delivered_customer_date IS NULL")
E6 = _funnel("TRUE")
E7 = PRELUDE + """
scores AS (SELECT unnest(map_entries(histogram(review_score))) AS e FROM w_reviews WHERE review_score IS NOT NULL)
SELECT e.key AS review_score, CAST(e.value AS BIGINT) AS n_reviews FROM scores
UNION ALL
SELECT NULL, COUNT(*) FROM w_reviews WHERE review_score IS NULL HAVING COUNT(*) > 0
ORDER BY review_score
"""
E8_REV = M02
E8_VOL = _CATEGORY + "SELECT * FROM best ORDER BY line_items DESC, category"


def _top_states(k: int) -> str:
    return f"SELECT * FROM ({M03}) s ORDER BY total_revenue DESC, customer_state LIMIT {k}"


# ---------------------------------------------------------------------------
# Views
# ---------------------------------------------------------------------------

D2 = f"FROM ({M01}) m WHERE order_count >= {views.MIN_MONTH_ORDERS} ORDER BY order_purchase_month"
D3_CAT = _CATEGORY + f"SELECT category, {_title('category')} AS category_label, total_revenue FROM best ORDER BY total_revenue DESC, category LIMIT 1"
D3_STATE = f"SELECT customer_state, total_revenue, order_count FROM ({_top_states(1)}) t"
D3_BARS = f"SELECT customer_state, total_revenue FROM ({_top_states(15)}) t"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_DEFINITIONS = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in views.SEGMENT_DEFINITIONS.items())
D4_TABLE = f"""
SELECT segment, COALESCE(definition, '') AS definition, customer_count, total_revenue, avg_revenue_per_customer
FROM ({M05}) s LEFT JOIN (VALUES {_DEFINITIONS}) d(segment, definition) USING (segment)
"""
D4_TOP = f"SELECT segment, total_revenue, customer_count FROM ({M05}) s ORDER BY total_revenue DESC, segment LIMIT 1"
D5 = (
    "SELECT CAST(cohort_month AS VARCHAR) AS cohort_month, "
    + ", ".join(f"any_value(retention_pct) FILTER (months_since_first = {k}) AS m{k}" for k in views.RETENTION_OFFSETS)
    + f" FROM ({M06}) m GROUP BY cohort_month"
)
D6 = f"SELECT ROUND(AVG(retention_pct), 2) AS avg_m1_retention FROM ({M06}) m WHERE months_since_first = 1"
D7 = f"""
WITH a AS ({M08}), b AS ({M10}),
c AS (SELECT max(pct_of_orders) FILTER (delivery_status = 'on_time') AS on_time_pct, max(pct_of_orders) FILTER (delivery_status = 'late') AS late_pct FROM a),
d AS (
    SELECT list_extract(list(avg_review_score) FILTER (delivery_status = 'on_time'), 1) AS score_on_time,
           list_extract(list(avg_review_score) FILTER (delivery_status = 'late'), 1) AS score_late,
           list_extract(list(pct_bad_reviews) FILTER (delivery_status = 'on_time'), 1) AS bad_on_time,
           list_extract(list(pct_bad_reviews) FILTER (delivery_status = 'late'), 1) AS bad_late
    FROM b
)
SELECT *, ROUND(score_late - score_on_time, 2) AS score_gap FROM c, d
"""
D8 = f"""
WITH s AS ({M09})
SELECT first(customer_state ORDER BY late_pct DESC, customer_state) AS worst_state, MAX(late_pct) AS worst_late_pct,
       first(customer_state ORDER BY late_pct, customer_state) AS best_state, MIN(late_pct) AS best_late_pct
FROM s HAVING COUNT(*) > 0
"""
D9 = f"SELECT payment_type, {_title('payment_type')} AS payment_label, pct_of_revenue FROM ({M11}) m ORDER BY total_revenue DESC, payment_type LIMIT 1"
D10 = f"SELECT any_value(pct_of_payments) FILTER (payment_installments = 1) AS pct_single_installment FROM ({M12}) m"
D11 = f"SELECT category, {_title('category')} AS category_label, avg_installments FROM ({M14}) m ORDER BY avg_installments DESC, category LIMIT 1"

# ---------------------------------------------------------------------------
# Quality
# ---------------------------------------------------------------------------


def _q2() -> str:
    one = lambda t, c: f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) AS n, COUNT({c}) AS known FROM {CTE[t]}"
    parts = _each([(t, c) for t in LOAD_ORDER for c in TABLES[t].column_names], lambda x: one(*x))
    return Q + f"SELECT table_name, column_name, ROUND(100.0 * (n - known) / n, 1) AS null_pct FROM ({parts}) x WHERE n > 0 AND ROUND(100.0 * (n - known) / n, 1) > 0"


def _q3() -> str:
    def one(t: str) -> str:
        k = ", ".join(KEY_CHECKS[t])
        return f"SELECT '{t}' AS table_name, '{k}' AS key_columns, COUNT(*) FILTER (n > 1) AS duplicate_groups FROM (SELECT COUNT(*) AS n FROM {CTE[t]} GROUP BY {k}) d HAVING COUNT(*) > 0"

    return Q + _each(KEY_CHECKS, one)


def _q4() -> str:
    one = lambda t: f"SELECT '{t}' AS table_name, '{DATE_RANGE_CHECKS[t]}' AS column_name, MIN({DATE_RANGE_CHECKS[t]}) AS min_value, MAX({DATE_RANGE_CHECKS[t]}) AS max_value FROM {CTE[t]} HAVING COUNT(*) > 0"
    return Q + _each(DATE_RANGE_CHECKS, one)


Q5 = Q + "SELECT COUNT(*) AS orphan_orders FROM w_orders ANTI JOIN w_customers USING (customer_id)"


def _q6() -> str:
    rows = []
    for t in LOAD_ORDER:
        spec, src = TABLES[t], CTE[t]
        if spec.primary_key:
            k, whole = ", ".join(spec.key), " AND ".join(f"{c} IS NOT NULL" for c in spec.key)
            rows.append((t, "PRIMARY KEY", k, f"COALESCE(SUM(if({whole}, CAST(n > 1 AS BIGINT), n)), 0) FROM (SELECT {k}, COUNT(*) AS n FROM {src} GROUP BY {k}) g"))
        rows += [(t, "NOT NULL", c, f"COUNT(*) - COUNT({c}) FROM {src}") for c in spec.not_null]
        for cols, target, there in spec.foreign_keys:
            label = f"{', '.join(cols)} -> {target}({', '.join(there)})"
            known = " AND ".join(f"s.{c} IS NOT NULL" for c in cols)
            on = " AND ".join(f"r.{a} = s.{b}" for a, b in zip(there, cols))
            rows.append((t, "FOREIGN KEY", label, f"COUNT(*) FROM (SELECT * FROM {src} s WHERE {known}) s ANTI JOIN {CTE[target]} r ON {on}"))
    one = lambda r: f"SELECT '{r[0]}' AS table_name, '{r[1]}' AS check_type, '{r[2]}' AS columns, CAST(v AS BIGINT) AS violations FROM (SELECT {r[3].replace(' FROM ', ' AS v FROM ', 1)}) q"
    return Q + _each(rows, one)


# ---------------------------------------------------------------------------
# Cleaning
# ---------------------------------------------------------------------------

_RAW = {t: c.replace("w_", "r_") for t, c in CTE.items()}
_TEXTS = {
    "product_category_translation": ("product_category_name", "product_category_name_english"),
    "customers": ("customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"),
    "sellers": ("seller_zip_code_prefix", "seller_city", "seller_state"),
    "geolocation": ("geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"),
    "products": ("product_category_name",),
    "orders": ("order_status",),
    "order_payments": ("payment_type",),
    "order_reviews": ("review_id", "review_comment_title", "review_comment_message"),
}
C1 = Q + _each(
    [(t, c) for t, texts in _TEXTS.items() for c in texts],
    lambda x: f"SELECT '{x[0]}' AS table_name, '{x[1]}' AS column_name, COUNT(*) FILTER ({x[1]} <> trim({x[1]}, {_BLANKS})) AS trimmed_rows, "
    f"CAST(COALESCE(SUM(length(trim({x[1]}, {_BLANKS}))), 0) AS BIGINT) AS characters_left FROM {_RAW[x[0]]}",
)


def _c2() -> str:
    done = {"product_category_translation": "c_translation", "products": "c_products", "orders": "c_orders"}
    one = lambda t: f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {_RAW[t]}) AS rows_before, (SELECT COUNT(*) FROM {done.get(t, CTE[t])}) AS rows_after"
    return Q + f"SELECT *, rows_before - rows_after AS removed_rows FROM ({_each(LOAD_ORDER, one)}) x"


C4 = Q + "SELECT product_id, product_category_name, product_category_name_english FROM w_products"
C4_UNTRANSLATED = Q + "SELECT COUNT(product_category_name) - COUNT(product_category_name_english) AS untranslated_products FROM w_products"
C5 = Q + "SELECT product_category_name, product_category_name_english FROM w_translation"
C6 = Q + "SELECT order_id, delivery_delay_days FROM w_orders"
C7 = Q + "SELECT order_id, order_purchase_month FROM w_orders"

# ---------------------------------------------------------------------------
# Statistics
# ---------------------------------------------------------------------------

_S1 = PRELUDE + f"""
timing AS (SELECT order_id, delivery_delay_days, delivery_delay_days > 0 AS is_late FROM w_orders WHERE delivery_delay_days IS NOT NULL),
sample AS (SELECT timing.*, if(is_late, '{stats.LATE}', '{stats.ON_TIME}') AS delivery_group, review_score FROM w_reviews JOIN timing USING (order_id)),
score AS (SELECT review_score AS v, COUNT(*) AS n, COUNT(*) FILTER (is_late) AS late FROM sample WHERE review_score IS NOT NULL GROUP BY v),
below AS (SELECT *, CAST(COALESCE((SELECT SUM(b.n) FROM score b WHERE b.v < score.v), 0) AS BIGINT) AS before FROM score),
ranked AS (SELECT *, before + (n + 1) / 2.0 AS rank FROM below)
"""
T1 = _S1 + "SELECT order_id, delivery_delay_days, delivery_group, review_score FROM sample"
T2 = _S1 + """
SELECT delivery_group, COUNT(*) AS n, ROUND(SUM(review_score) / COUNT(review_score), 6) AS mean,
       ROUND(quantile_cont(review_score, 0.5), 6) AS median, ROUND(sqrt(var_samp(review_score)), 6) AS std
FROM sample GROUP BY delivery_group
"""
W6 = _S1 + "SELECT v AS review_score, n, before AS rank_before, CAST(rank AS DOUBLE) AS avg_rank FROM ranked"
T11 = _S1 + "SELECT delivery_group, CAST(floor(review_score + 0.5) AS BIGINT) AS score_bin, COUNT(*) AS n FROM sample GROUP BY ALL"

_U = _S1 + """,
sums AS (
    SELECT CAST(SUM(late) AS DOUBLE) AS n1, CAST(SUM(n - late) AS DOUBLE) AS n2, CAST(SUM(late * rank) AS DOUBLE) AS r1,
           CAST(SUM(pow(n, 3) - n) AS DOUBLE) AS ties FROM ranked
),
u AS (SELECT *, r1 - n1 * (n1 + 1) / 2 AS u1, 1.0 - 2 * (r1 - n1 * (n1 + 1) / 2) / NULLIF(n1 * n2, 0) AS r FROM sums),
z AS (
    SELECT *, (greatest(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5)
              / NULLIF(sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))), 0) AS z FROM u
)
"""
_COUNTS = "CAST(n1 AS BIGINT) AS n_late, CAST(n2 AS BIGINT) AS n_on_time, ROUND(u1, 6) AS u_statistic"
T3 = _U + f"SELECT {_COUNTS}, ROUND(ties, 6) AS tie_term, ROUND(z, 6) AS z FROM z"
T5 = _U + f"SELECT {_COUNTS}, ROUND(r, 6) AS rank_biserial FROM u"
_LABELS = " ".join(f"WHEN abs(r) < {bound} THEN '{label}'" for bound, label in stats.EFFECT_THRESHOLDS)
T6 = _U + f"SELECT ROUND(r, 6) AS rank_biserial, CASE {_LABELS} ELSE '{stats.LARGEST_EFFECT}' END AS effect_size FROM u"

_WELCH = _S1 + """,
side AS (SELECT is_late, CAST(COUNT(*) AS DOUBLE) AS n, AVG(review_score) AS m, var_samp(review_score) / COUNT(*) AS e FROM sample GROUP BY is_late),
w AS (
    SELECT (a.m - b.m) / NULLIF(sqrt(a.e + b.e), 0) AS t, pow(a.e + b.e, 2) / NULLIF(a.e * a.e / (a.n - 1) + b.e * b.e / (b.n - 1), 0) AS df
    FROM side a, side b WHERE a.is_late AND NOT b.is_late
)
"""
T4 = _WELCH + "SELECT ROUND(t, 6) AS t_statistic, ROUND(df, 6) AS df FROM w"

_S2 = PRELUDE + """
longest AS (SELECT order_id, MAX(payment_installments) AS installments FROM w_payments WHERE payment_installments > 0 GROUP BY order_id),
pair AS (SELECT DISTINCT order_id, installments, review_score FROM longest JOIN w_reviews USING (order_id)),
joint AS (SELECT installments AS x, review_score AS y, COUNT(*) AS c FROM pair GROUP BY ALL)
"""
T7 = _S2 + "SELECT * FROM pair"


def _described(c: str) -> str:
    quarter = lambda q: f"ROUND(quantile_cont({c}, {q}), 6)"
    return (
        f"SELECT '{c}' AS variable, COUNT({c}) AS count, ROUND(SUM({c}) / COUNT({c}), 6) AS mean, ROUND(sqrt(var_samp({c})), 6) AS std, "
        f"CAST(MIN({c}) AS DOUBLE) AS min, {quarter(0.25)} AS p25, {quarter(0.5)} AS p50, {quarter(0.75)} AS p75, CAST(MAX({c}) AS DOUBLE) AS max FROM pair"
    )


T8 = _S2 + _each(("installments", "review_score"), _described)
T10 = _S2 + f"""
SELECT x AS installments, ROUND(CAST(SUM(c * y) AS DOUBLE) / SUM(c), 6) AS mean_review_score
FROM joint WHERE x <= {stats.MAX_INSTALLMENTS_SHOWN} GROUP BY x ORDER BY x
"""
_RHO = _S2 + """,
ranks AS (
    SELECT CAST(c AS DOUBLE) AS c,
           (SELECT SUM(b.c) FILTER (b.x < joint.x) FROM joint b) AS below_x, (SELECT SUM(b.c) FILTER (b.x = joint.x) FROM joint b) AS same_x,
           (SELECT SUM(b.c) FILTER (b.y < joint.y) FROM joint b) AS below_y, (SELECT SUM(b.c) FILTER (b.y = joint.y) FROM joint b) AS same_y
    FROM joint
),
mid AS (
    SELECT c, CAST(COALESCE(below_x, 0) + (same_x + 1) / 2.0 AS DOUBLE) AS rx, CAST(COALESCE(below_y, 0) + (same_y + 1) / 2.0 AS DOUBLE) AS ry FROM ranks
),
m AS (SELECT SUM(c) AS n, SUM(c * rx) / SUM(c) AS mx, SUM(c * ry) / SUM(c) AS my FROM mid),
rho AS (
    SELECT CAST(any_value(n) AS BIGINT) AS n,
           SUM(c * (rx - mx) * (ry - my)) / NULLIF(sqrt(SUM(c * pow(rx - mx, 2)) * SUM(c * pow(ry - my, 2))), 0) AS rho FROM mid, m
)
"""
T9 = _RHO + "SELECT n, ROUND(rho, 6) AS rho FROM rho"


# --- tails: the quadrature of souk.functions.dist in SQL ---------------------


def _sum_of(log_density: str) -> str:
    """Exp-sinh sum of exp(log_density), an expression in y."""
    u = f"(k / {float(dist.STEPS_TO_ONE)})"
    y = f"exp({math.pi / 4!r} * (exp({u}) - exp(-{u})))"
    points = f"range({-dist.REACH * dist.STEPS_TO_ONE}, {dist.REACH * dist.STEPS_TO_ONE + 1})"
    term = f"{y} * {math.pi / 4 / dist.STEPS_TO_ONE!r} * (exp({u}) + exp(-{u})) * exp({log_density.replace('y', y)})"
    return f"list_sum(list_transform({points}, lambda k: {term}))"


def _norm_tail(z: str) -> str:
    return f"if({z} IS NULL, NULL, least(1.0, {2 / math.sqrt(2 * math.pi)!r} * {_sum_of(f'-pow(abs({z}) + y, 2) / 2')}))"


def _t_tail(t: str, v: str) -> str:
    s = f"(pow(abs({t}) + y, 2) / {v})"
    log1p = f"if({s} < {dist.SMALL}, {s} * (1 - {s} * (1 / 2 - {s} * (1 / 3 - {s} * (1 / 4 - {s} * (1 / 5 - {s} / 6))))), ln(1 + {s}))"
    x = f"({v} / 2)"
    b = f"({x} + {dist.SHIFT})"
    ratio = f"sqrt({b}) * exp(-1 / (8 * {b}) + 1 / (192 * pow({b}, 3)) - 1 / (640 * pow({b}, 5)) + 17 / (14336 * pow({b}, 7)))"
    steps = f"list_product(list_transform(range(0, {dist.SHIFT}), lambda j: ({x} + j) / ({x} + j + 0.5)))"
    tail = f"least(1.0, 2 * {ratio} * {steps} / sqrt({v} * pi()) * {_sum_of(f'-({v} + 1) / 2 * {log1p}')})"
    return f"if({t} IS NULL OR {v} IS NULL, NULL, {tail})"


_P = stats.P_DIGITS
T3P = _U + f"SELECT CAST(n1 AS BIGINT) AS n_late, CAST(n2 AS BIGINT) AS n_on_time, ROUND(u1, 6) AS u_statistic, ROUND({_norm_tail('z')}, {_P}) AS p_value FROM z"
# the exact p: every arrangement of the ranks is a number whose set bits are the ranks of the late values; with ties as T3P
T3X = _S1 + f""",
day AS (SELECT is_late, dayofweek(order_purchase_timestamp) AS weekday, AVG(review_score) AS mean_score
        FROM sample JOIN w_orders USING (order_id) WHERE order_purchase_timestamp IS NOT NULL GROUP BY ALL),
placed AS (SELECT is_late, count(*) OVER (PARTITION BY mean_score) AS same, rank() OVER (ORDER BY mean_score) AS low FROM day WHERE mean_score IS NOT NULL),
figures AS (SELECT count(*) FILTER (is_late) AS n1, count(*) FILTER (NOT is_late) AS n2, sum(low + (same - 1) / 2) FILTER (is_late) AS r1,
                   sum(same * same - 1) AS ties FROM placed),
observed AS (SELECT n1, n2, ties, r1 - n1 * (n1 + 1) / 2 AS u FROM figures),
arranged AS (
    SELECT list_sum([i for i in range(1, n1 + n2 + 1) if (x >> (i - 1)) & 1 = 1]) - n1 * (n1 + 1) // 2 AS v
    FROM observed, range(0, 1 << 14) bits(x) WHERE x < (1 << (n1 + n2)) AND bit_count(x) = n1
),
z AS (
    SELECT *, (greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5)
              / NULLIF(sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))), 0) AS z FROM observed
)
SELECT CAST(n1 AS BIGINT) AS n_late, CAST(n2 AS BIGINT) AS n_on_time, ROUND(CAST(u AS DOUBLE), 6) AS u_statistic,
       ROUND(CASE WHEN ties > 0 THEN {_norm_tail('z')}
             ELSE least(1.0, 2.0 * (SELECT count(*) FROM arranged WHERE v >= greatest(u, n1 * n2 - u)) / (SELECT count(*) FROM arranged)) END, {_P}) AS p_value
FROM z
"""
T4P = _WELCH + f"SELECT ROUND(t, 6) AS t_statistic, ROUND(df, 6) AS df, ROUND({_t_tail('t', 'df')}, {_P}) AS p_value FROM w"
T9P = _RHO + f""",
tv AS (SELECT n, rho, CASE WHEN n > 2 AND abs(rho) < 1 THEN rho * sqrt((n - 2) / (1 - rho * rho)) END AS tt, CAST(n - 2 AS DOUBLE) AS df FROM rho)
SELECT n, ROUND(rho, 6) AS rho, CASE WHEN n < 3 THEN NULL WHEN abs(rho) >= 1 THEN 0.0 ELSE ROUND({_t_tail('tt', 'df')}, {_P}) END AS p_value FROM tv
"""

ORACLES: dict[str, str] = {
    "M01_monthly_revenue_trend": M01,
    "M02_revenue_by_category": M02,
    "M03_revenue_by_state": M03,
    "M04_rfm_customers": M04,
    "M05_rfm_segment_summary": M05,
    "M06_cohort_retention_matrix": M06,
    "M07_cohort_sizes": M07,
    "M08_delivery_rate_overall": M08,
    "M09_delivery_delay_by_state": M09,
    "M10_review_score_by_delivery": M10,
    "M11_payment_type_mix": M11,
    "M12_installment_distribution": M12,
    "M13_avg_payment_value_by_installments": M13,
    "M14_credit_card_installments_by_category": M14,
    "M15_summary_kpis": M15,
    "W5_rfm_scores": W5,
    "W6_review_score_avg_rank": W6,
    "A9_having_min_payments_800": A9,
    "E1_table_row_counts": E1,
    "E2_missing_in_orders": E2,
    "E3_undelivered_status": E3,
    "E4_missing_in_reviews": E4,
    "E5_missing_in_products": E5,
    "E6_status_funnel": E6,
    "E7_review_distribution": E7,
    "E8_top_categories_by_revenue": E8_REV,
    "E8_top_categories_by_volume": E8_VOL,
    "E9_top10_states_by_revenue": _top_states(10),
    "E9_top15_states_by_revenue": _top_states(15),
    "D1_kpi_row": M15,
    "D2_monthly_trend_view": D2,
    "D3_top_category": D3_CAT,
    "D3_top_state": D3_STATE,
    "D3_state_revenue_bars": D3_BARS,
    "D4_segment_table": D4_TABLE,
    "D4_top_segment": D4_TOP,
    "D5_retention_wide": D5,
    "D6_month1_retention": D6,
    "D7_late_vs_on_time": D7,
    "D8_worst_best_state": D8,
    "D9_dominant_payment": D9,
    "D10_single_installment_share": D10,
    "D11_most_installments_category": D11,
    "Q1_row_counts": E1,
    "Q2_null_percent": _q2(),
    "Q3_duplicate_keys": _q3(),
    "Q4_date_ranges": _q4(),
    "Q5_orphan_orders": Q5,
    "Q6_declared_constraints": _q6(),
    "C1_trim_strings": C1,
    "C2_dedupe_counts": _c2(),
    "C4_translated_products": C4,
    "C4_untranslated_count": C4_UNTRANSLATED,
    "C5_category_translation": C5,
    "C6_delivery_delay": C6,
    "C7_purchase_month": C7,
    "T1_late_review_sample": T1,
    "T2_group_descriptives": T2,
    "T3_mann_whitney_u": T3,
    "T3p_mann_whitney_p": T3P,
    "T3x_weekday_means_exact_p": T3X,
    "T4_welch_t": T4,
    "T4p_welch_p": T4P,
    "T5_rank_biserial": T5,
    "T6_effect_size": T6,
    "T7_installment_review_sample": T7,
    "T8_installment_review_describe": T8,
    "T9_spearman": T9,
    "T9p_spearman_p": T9P,
    "T10_mean_score_by_installments": T10,
    "T11_score_histogram": T11,
}
