"""The registered queries as plain SQL, for DuckDB over the same files.

Written independently of the plans: whole joins first, grouping last.
"""

from __future__ import annotations

import re

from shopmart.testdata import ACCEPTED_STATUSES, PAYMENT_TYPES, TRANSLATED_TYPES

# The test tables as raw tables, then the models over them.
_CTES: dict[str, str] = {
    "raw_orders": """
        SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
               o.o_orderstatus AS order_status, o.o_orderdate AS order_purchase_timestamp,
               o.o_orderdate + to_days(1) AS order_approved_at,
               s.first_ship AS order_delivered_carrier_date,
               s.last_ship AS order_delivered_customer_date,
               o.o_orderdate + to_days(CAST(30 + o.o_orderkey % 60 AS INTEGER))
                   AS order_estimated_delivery_date
        FROM orders o
        LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
                   FROM lineitem GROUP BY l_orderkey) s ON o.o_orderkey = s.l_orderkey""",
    "raw_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CAST(l_tax AS DECIMAL(4,2)) * CAST(l_extendedprice AS DECIMAL(12,2))
                   AS freight_value
        FROM lineitem""",
    "raw_customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_unique_id,
               c_nationkey AS customer_zip_code_prefix, c_mktsegment AS customer_city,
               n_name AS customer_state
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "raw_sellers": """
        SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code_prefix,
               n_name AS seller_city, r_name AS seller_state
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    "raw_geolocation": """
        SELECT c_nationkey + 5 AS geolocation_zip_code_prefix,
               CAST(c_acctbal AS DECIMAL(12,2)) AS geolocation_lat,
               c_custkey AS geolocation_lng, c_mktsegment AS geolocation_city,
               n_name AS geolocation_state, c_custkey AS row_key
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "raw_products": """
        SELECT p_partkey AS product_id, p_type AS product_category_name,
               CAST(length(p_name) AS INTEGER) AS product_name_lenght,
               CAST(NULL AS INTEGER) AS product_description_lenght,
               CAST(NULL AS INTEGER) AS product_photos_qty, p_size AS product_weight_g,
               CAST(NULL AS INTEGER) AS product_length_cm,
               CAST(NULL AS INTEGER) AS product_height_cm,
               CAST(NULL AS INTEGER) AS product_width_cm
        FROM part""",
    "raw_translation": "SELECT * FROM (VALUES "
    + ", ".join(f"('{name}', lower('{name}'))" for name in TRANSLATED_TYPES)
    + ") t(product_category_name, product_category_name_english)",
    "raw_payments": """
        SELECT o_orderkey AS order_id, 1 AS payment_sequential, o_orderpriority AS payment_type,
               CAST(1 + o_orderkey % 12 AS INTEGER) AS payment_installments,
               CAST(o_totalprice AS DECIMAL(12,2)) AS payment_value
        FROM orders""",
    "raw_reviews": """
        SELECT event_id // 2 AS order_id, CAST(1 + user_id % 5 AS INTEGER) AS review_score
        FROM events""",
    "silver_geo": """
        SELECT geolocation_zip_code_prefix,
               CAST(sum(geolocation_lat) AS DOUBLE) / count(geolocation_lat) AS latitude,
               CAST(sum(geolocation_lng) AS DOUBLE) / count(geolocation_lng) AS longitude,
               min_by(geolocation_city, row_key) AS city,
               min_by(geolocation_state, row_key) AS state
        FROM raw_geolocation GROUP BY geolocation_zip_code_prefix""",
    "silver_named": """
        SELECT geolocation_zip_code_prefix,
               CAST(sum(geolocation_lat) AS DOUBLE) / count(geolocation_lat) AS latitude,
               CAST(sum(geolocation_lng) AS DOUBLE) / count(geolocation_lng) AS longitude,
               min(row(geolocation_city, geolocation_state))[1] AS city,
               min(row(geolocation_city, geolocation_state))[2] AS state
        FROM raw_geolocation GROUP BY geolocation_zip_code_prefix""",
    "customers_located": """
        SELECT c.*, g.latitude AS customer_latitude, g.longitude AS customer_longitude
        FROM raw_customers c LEFT JOIN silver_geo g
        ON c.customer_zip_code_prefix = g.geolocation_zip_code_prefix""",
    "sellers_located": """
        SELECT s.*, g.latitude AS seller_latitude, g.longitude AS seller_longitude
        FROM raw_sellers s LEFT JOIN silver_geo g
        ON s.seller_zip_code_prefix = g.geolocation_zip_code_prefix""",
    "order_scores": """
        SELECT order_id, avg(review_score) AS review_score FROM raw_reviews GROUP BY order_id""",
    "products_en": """
        SELECT p.*, t.product_category_name_english
        FROM raw_products p LEFT JOIN raw_translation t USING (product_category_name)""",
    "fact": """
        SELECT concat_ws('_', i.order_id, i.order_item_id) AS order_item_key, i.*,
               o.customer_id, i.price + i.freight_value AS item_revenue,
               CAST(date_diff('day', o.order_purchase_timestamp, o.order_delivered_customer_date)
                   AS INTEGER) AS delivery_time_days,
               r.review_score
        FROM raw_items i JOIN raw_orders o USING (order_id)
        LEFT JOIN order_scores r USING (order_id)""",
    "joined": """
        WITH o AS (SELECT order_id, order_status, order_purchase_timestamp FROM raw_orders),
             p AS (SELECT product_id, product_category_name_english FROM products_en),
             s AS (SELECT seller_id AS known_seller, seller_city, seller_state FROM raw_sellers),
             c AS (SELECT customer_id, customer_city, customer_state FROM raw_customers)
        SELECT fact.* EXCLUDE (order_item_id, product_id, seller_id, customer_id),
               order_status, order_purchase_timestamp, product_category_name_english,
               known_seller AS seller_id, seller_city, seller_state, customer_city,
               customer_state
        FROM fact LEFT JOIN o USING (order_id)
        LEFT JOIN p USING (product_id)
        LEFT JOIN s ON seller_id = known_seller
        LEFT JOIN c USING (customer_id)""",
    "payments_joined": """
        SELECT payment_type, payment_value, order_purchase_timestamp
        FROM raw_payments LEFT JOIN raw_orders USING (order_id)""",
    "delay": """
        SELECT *, CASE WHEN order_delivered_customer_date > order_estimated_delivery_date
                       THEN 1 ELSE 0 END AS is_delayed,
               CAST(date_diff('day', order_purchase_timestamp, order_estimated_delivery_date)
                   AS INTEGER) AS estimated_duration_days,
               CAST(dayofweek(order_purchase_timestamp) + 1 AS INTEGER) AS purchase_day_of_week
        FROM raw_orders
        WHERE order_purchase_timestamp IS NOT NULL AND order_estimated_delivery_date IS NOT NULL""",
}

# Newton steps on the training orders, counted by features and label: each solves three equations by Cramer's rule.
_SUMS = ", ".join(
    f"sum(n * p * (1 - p) * {x}) AS {name}"
    for name, x in (
        ("a", "1"), ("b", "x"), ("c", "y"), ("d", "x * x"), ("e", "x * y"), ("f", "y * y"),
    )
)
_FITTED = f"""
    WITH RECURSIVE counted AS (
        SELECT CAST(estimated_duration_days AS DOUBLE) AS x, CAST(purchase_day_of_week AS DOUBLE) AS y,
               is_delayed AS label, count(*) AS n
        FROM delay WHERE order_id % 10 < 8 GROUP BY ALL
    ), fit(k, u, v, w) AS (
        SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)
        UNION ALL
        SELECT k + 1,
               u + (r * (d * f - e * e) - b * (s * f - e * t) + c * (s * e - d * t)) / det,
               v + (a * (s * f - e * t) - r * (b * f - e * c) + c * (b * t - s * c)) / det,
               w + (a * (d * t - s * e) - b * (b * t - s * c) + r * (b * e - d * c)) / det
        FROM (SELECT *, a * (d * f - e * e) - b * (b * f - e * c) + c * (b * e - d * c) AS det
              FROM (SELECT k, u, v, w, {_SUMS},
                           sum(n * (label - p)) AS r, sum(n * (label - p) * x) AS s, sum(n * (label - p) * y) AS t
                    FROM (SELECT *, 1 / (1 + exp(-(u + v * x + w * y))) AS p FROM fit, counted WHERE k < 12) q
                    GROUP BY k, u, v, w) sums) steps
    )
    SELECT order_id, customer_id, is_delayed,
           u + v * estimated_duration_days + w * purchase_day_of_week AS margin
    FROM delay, (SELECT u, v, w FROM fit WHERE k = 12) best
    WHERE order_id % 10 >= 8"""

_MONTH = "CAST(date_trunc('month', order_purchase_timestamp) AS DATE)"

_RAW_NAMES = {
    "customers": "raw_customers",
    "geolocation": "raw_geolocation",
    "order_items": "raw_items",
    "order_payments": "raw_payments",
    "order_reviews": "raw_reviews",
    "orders": "raw_orders",
    "products": "raw_products",
    "sellers": "raw_sellers",
    "product_category_name_translation": "raw_translation",
}


def _with_ctes(sql: str) -> str:
    """Prepend the named tables the query refers to, each after those it needs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in _CTES.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN) {name}\b", text):
                visit(body)
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{name} AS ({_CTES[name]})" for name in needed) + "\n" + sql


def _profile(table: str, source: str, columns: str = "*") -> str:
    total = f"(SELECT count(*) FROM {source})"
    distinct = f"(SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {source}) d)"
    return (
        f"SELECT '{table}' AS table_name, {total} AS total_rows, {distinct} AS distinct_rows, "
        f"{total} - {distinct} AS duplicate_rows"
    )


def _check(model: str, column: str, test: str, source: str, condition: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS column_name, '{test}' AS test, "
        f"count(*) AS failures FROM {source} WHERE {condition}"
    )


def _unique(model: str, column: str, source: str) -> str:
    repeated = (
        f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1) q"
    )
    return _check(model, column, "unique", repeated, "TRUE")


def _not_null(model: str, column: str, source: str) -> str:
    return _check(model, column, "not_null", source, f"{column} IS NULL")


def _fanout(name: str, left: str, left_key: str, right: str, right_key: str) -> str:
    per_key = (
        f"(SELECT {right_key} AS k, count(*) AS n FROM {right} "
        f"WHERE {right_key} IS NOT NULL GROUP BY {right_key})"
    )
    join = f"FROM {left} LEFT JOIN {per_key} r ON {left_key} = r.k"
    return f"""
        SELECT '{name}' AS join_name, (SELECT count(*) FROM {left}) AS left_rows,
               (SELECT count(*) FROM {per_key} x WHERE n > 1) AS repeated_keys,
               (SELECT max(n) FROM {per_key} y) AS max_rows_per_key,
               (SELECT CAST(sum(coalesce(r.n, 1)) AS DOUBLE) {join}) AS joined_rows,
               CAST((SELECT count(*) FROM {left}) AS DOUBLE) AS joined_rows_after_grouping"""


# The stated model of the registered queries.
_MARGIN = "-1.25 + 0.031e0 * estimated_duration_days - 0.17e0 * purchase_day_of_week"

_NOT_ACCEPTED = "order_status NOT IN (" + ", ".join(f"'{s}'" for s in ACCEPTED_STATUSES) + ")"

_PIVOT = ", ".join(
    f"""CAST(sum(CASE WHEN payment_type = '{t}' THEN payment_value END) AS DOUBLE) AS "{t}" """
    for t in PAYMENT_TYPES
)

_LISTED = ", ".join(f"'{t}'" for t in PAYMENT_TYPES)

_GEO_CHECK = _not_null("silver_geolocation", "geolocation_zip_code_prefix", "silver_geo")
_NOT_NULLS = [
    _GEO_CHECK,
    _not_null("dim_customers", "customer_id", "customers_located"),
    _not_null("dim_customers", "customer_unique_id", "customers_located"),
    _not_null("dim_orders", "order_id", "raw_orders"),
    _not_null("fact_order_items", "order_id", "fact"),
    _not_null("fact_order_items", "order_item_id", "fact"),
    _not_null("fact_order_items", "price", "fact"),
]
_UNIQUES = [
    _unique("dim_customers", "customer_id", "customers_located"),
    _unique("dim_orders", "order_id", "raw_orders"),
]
_ACCEPTED = _check(
    "dim_orders", "order_status", "accepted_values", "raw_orders", _NOT_ACCEPTED
)


def _groups(group: str, metric: str, alias: str, source: str) -> str:
    return f"SELECT {group}, {metric} AS {alias} FROM {source} GROUP BY {group}"


def _top(group: str, metric: str, alias: str, source: str, limit: int) -> str:
    return (
        f"SELECT {group}, {metric} AS {alias} FROM {source} GROUP BY {group} "
        f"ORDER BY {alias} DESC NULLS LAST, {group} ASC NULLS LAST LIMIT {limit}"
    )


def _sum(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE)"


_QUERIES: dict[str, str] = {
    "scan_parquet": "SELECT * FROM orders",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {cte}"
        for name, cte in _RAW_NAMES.items()
    ),
    "distinct_rows": """
        SELECT DISTINCT * REPLACE (CAST(price AS DOUBLE) AS price,
                                   CAST(freight_value AS DOUBLE) AS freight_value)
        FROM raw_items""",
    "distinct_item_ids": "SELECT DISTINCT order_id, order_item_id FROM raw_items",
    "duplicate_profile": " UNION ALL ".join(
        [_profile(name, cte) for name, cte in _RAW_NAMES.items()]
        + [_profile("order_item_ids", "raw_items", "order_id, order_item_id")]
    ),
    "silver_geolocation": "SELECT * FROM silver_geo",
    "silver_geolocation_by_name": "SELECT * FROM silver_named",
    "reviews_per_order": "SELECT * FROM order_scores",
    "dim_customers": "SELECT * FROM customers_located",
    "dim_sellers": "SELECT * FROM sellers_located",
    "dim_products": "SELECT * FROM products_en",
    "dim_orders": "SELECT * FROM raw_orders",
    "dim_payments": """
        SELECT * REPLACE (CAST(payment_value AS DOUBLE) AS payment_value) FROM raw_payments""",
    "fact_order_items": """
        SELECT * REPLACE (CAST(price AS DOUBLE) AS price,
                          CAST(freight_value AS DOUBLE) AS freight_value,
                          CAST(item_revenue AS DOUBLE) AS item_revenue) FROM fact""",
    "dw_joined": """
        SELECT * REPLACE (CAST(price AS DOUBLE) AS price,
                          CAST(freight_value AS DOUBLE) AS freight_value,
                          CAST(item_revenue AS DOUBLE) AS item_revenue) FROM joined""",
    "dw_joined_from_fact": """
        SELECT * REPLACE (CAST(price AS DOUBLE) AS price,
                          CAST(freight_value AS DOUBLE) AS freight_value,
                          CAST(item_revenue AS DOUBLE) AS item_revenue) FROM joined""",
    "dw_payments_joined": """
        SELECT * REPLACE (CAST(payment_value AS DOUBLE) AS payment_value) FROM payments_joined""",
    "join_fanout_check": " UNION ALL ".join(
        [
            _fanout(
                "customers_geolocation",
                "raw_customers",
                "customer_zip_code_prefix",
                "raw_geolocation",
                "geolocation_zip_code_prefix",
            ),
            _fanout(
                "sellers_geolocation",
                "raw_sellers",
                "seller_zip_code_prefix",
                "raw_geolocation",
                "geolocation_zip_code_prefix",
            ),
            _fanout("items_reviews", "raw_items", "order_id", "raw_reviews", "order_id"),
            _fanout("items_payments", "raw_items", "order_id", "raw_payments", "order_id"),
        ]
    ),
    "sales_summary": f"""
        SELECT {_MONTH} AS order_month, product_category_name_english, seller_id, customer_state,
               count(*) AS items, {_sum("item_revenue")} AS revenue,
               CAST(sum(delivery_time_days) AS BIGINT) AS days, count(delivery_time_days) AS delivered,
               {_sum("CAST(review_score AS DECIMAL(18,12))")} AS score, count(review_score) AS scored
        FROM joined GROUP BY 1, 2, 3, 4""",
    "bi_orders_over_time": f"""
        SELECT {_MONTH} AS order_month, count(*) AS order_count FROM raw_orders
        GROUP BY 1""",
    "bi_payment_methods": _groups("payment_type", "count(*)", "payment_count", "raw_payments"),
    "bi_top_cities": _top("customer_city", "count(*)", "customer_count", "raw_customers", 20),
    "bi_top_products": _top("product_id", _sum("price"), "total_revenue", "raw_items", 15),
    "bi_order_status": _groups("order_status", "count(*)", "order_count", "raw_orders"),
    "bi_monthly_revenue": f"""
        SELECT {_MONTH} AS order_month, {_sum("item_revenue")} AS revenue FROM joined
        GROUP BY 1""",
    "bi_revenue_by_category": _top(
        "product_category_name_english", _sum("item_revenue"), "revenue", "joined", 15
    ),
    "bi_top_sellers": _top("seller_id", _sum("item_revenue"), "revenue", "joined", 15),
    "bi_sales_by_state": _groups("customer_state", _sum("item_revenue"), "revenue", "joined"),
    "bi_delivery_by_state": _top(
        "customer_state", "avg(delivery_time_days)", "avg_delivery_days", "joined", 30
    ),
    "bi_payment_trends": f"""
        SELECT {_MONTH} AS order_month, payment_type, {_sum("payment_value")} AS total_value
        FROM payments_joined GROUP BY 1, 2""",
    "bi_payment_trends_pivot": f"""
        SELECT {_MONTH} AS order_month, {_PIVOT},
               CAST(sum(CASE WHEN payment_type NOT IN ({_LISTED}) THEN payment_value END)
                   AS DOUBLE) AS other,
               CAST(sum(CASE WHEN payment_type IS NULL THEN payment_value END)
                   AS DOUBLE) AS unknown
        FROM payments_joined GROUP BY 1""",
    "bi_review_by_category": _top(
        "product_category_name_english", "avg(review_score)", "avg_review_score", "joined", 15
    ),
    "ml_delay_features": """
        SELECT order_id, customer_id, is_delayed, estimated_duration_days, purchase_day_of_week
        FROM delay""",
    "ml_split_counts": """
        SELECT CASE WHEN order_id % 10 < 8 THEN 'train' ELSE 'test' END AS side,
               count(*) AS n_rows, CAST(sum(is_delayed) AS BIGINT) AS n_delayed
        FROM delay GROUP BY 1""",
    "ml_scores": f"""
        SELECT order_id, customer_id, is_delayed,
               CAST({_MARGIN} > 0 AS DOUBLE) AS predicted_delay,
               round(1 / (1 + exp(-({_MARGIN}))), 9) AS delayed_probability
        FROM delay""",
    "ml_auc_stated": f"""
        SELECT n_rows, round((ranks - pos * (pos + 1) / 2) / (pos * (n_rows - pos)), 9) AS auc
        FROM (SELECT count(*) AS n_rows, CAST(sum(is_delayed) AS DOUBLE) AS pos,
                     CAST(sum(CASE WHEN is_delayed = 1 THEN mean_rank END) AS DOUBLE) AS ranks
              FROM (SELECT is_delayed,
                           rank() OVER (ORDER BY margin)
                           + (count(*) OVER (PARTITION BY margin) - 1) / 2.0 AS mean_rank
                    FROM (SELECT is_delayed, round({_MARGIN}, 12) AS margin FROM delay) m) r) s""",
    "ml_predictions": f"""
        SELECT order_id, customer_id, is_delayed, CAST(margin > 0 AS DOUBLE) AS predicted_delay,
               round(1 / (1 + exp(-margin)), 6) AS delayed_probability
        FROM ({_FITTED}) scored""",
    "ml_auc": f"""
        SELECT n_rows, round((ranks - pos * (pos + 1) / 2) / (pos * (n_rows - pos)), 6) AS auc
        FROM (SELECT count(*) AS n_rows, CAST(sum(is_delayed) AS DOUBLE) AS pos,
                     CAST(sum(CASE WHEN is_delayed = 1 THEN mean_rank END) AS DOUBLE) AS ranks
              FROM (SELECT is_delayed,
                           rank() OVER (ORDER BY margin)
                           + (count(*) OVER (PARTITION BY margin) - 1) / 2.0 AS mean_rank
                    FROM (SELECT is_delayed, round(margin, 12) AS margin FROM ({_FITTED}) scored) m) r) s""",
    "ml_library_fit": """
        SELECT count(*) AS n_rows, true AS is_close FROM delay WHERE order_id % 10 >= 8""",
    "ml_test_orders": """
        SELECT order_id, customer_id, is_delayed FROM delay WHERE order_id % 10 >= 8""",
    "dq_unique": " UNION ALL ".join(
        [
            *_UNIQUES,
            _unique("dim_products", "product_id", "products_en"),
            _unique("dim_sellers", "seller_id", "sellers_located"),
            _unique("fact_order_items", "order_item_key", "fact"),
        ]
    ),
    "dq_not_null": " UNION ALL ".join(_NOT_NULLS),
    "dq_accepted_values": _ACCEPTED,
    "dq_expression": _check(
        "fact_order_items", "item_revenue", "expression", "fact", "NOT (item_revenue > 0)"
    ),
    "dq_report": " UNION ALL ".join([*_UNIQUES, *_NOT_NULLS, _ACCEPTED]),
}


def oracle_sql() -> dict[str, str]:
    return {name: _with_ctes(sql) for name, sql in _QUERIES.items()}
