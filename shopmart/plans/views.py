"""The two wide views as SQL over registered tables, for every session of the catalog."""

from __future__ import annotations

from shopmart.plans.marts import JOINED_COLUMNS
from shopmart.sinks.catalog import qualified

# Which table of the join a column of the wide view comes from; all others are the fact's.
_FROM = {
    "order_status": "o",
    "order_purchase_timestamp": "o",
    "customer_city": "o",
    "customer_state": "o",
    "product_category_name_english": "p",
    "seller_id": "s",
    "seller_city": "s",
    "seller_state": "s",
}


def dw_joined(database: str) -> str:
    """Items with their order, its customer, product and seller.

    Orders meet their customers first, so the fact is shuffled once for both.
    """
    columns = ", ".join(f"{_FROM.get(c, 'f')}.{c}" for c in JOINED_COLUMNS)
    fact, orders, customers, products, sellers = (
        qualified(database, t)
        for t in ("fact_order_items", "dim_orders", "dim_customers", "dim_products", "dim_sellers")
    )
    return f"""
        SELECT {columns}
        FROM {fact} f
        LEFT JOIN (
            SELECT d.order_id, d.order_status, d.order_purchase_timestamp, c.customer_city, c.customer_state
            FROM {orders} d LEFT JOIN {customers} c ON d.customer_id = c.customer_id
        ) o ON f.order_id = o.order_id
        LEFT JOIN {products} p ON f.product_id = p.product_id
        LEFT JOIN {sellers} s ON f.seller_id = s.seller_id"""


def dw_payments_joined(database: str) -> str:
    """Payments with the purchase time of their order, NULL if it is missing."""
    payments, orders = qualified(database, "dim_payments"), qualified(database, "dim_orders")
    return f"""
        SELECT p.payment_type, p.payment_value, o.order_purchase_timestamp
        FROM {payments} p LEFT JOIN {orders} o ON p.order_id = o.order_id"""


VIEWS = {"dw_joined": dw_joined, "dw_payments_joined": dw_payments_joined}
