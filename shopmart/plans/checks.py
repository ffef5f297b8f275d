"""Declared tests of the models."""

from __future__ import annotations

from collections.abc import Sequence

from shopmart.operators.quality import Check, accepted_values, expression, not_null, unique
from shopmart.schemas import ORDER_STATUSES


def declared_checks(statuses: Sequence[str] = ORDER_STATUSES) -> list[Check]:
    """The ten tests that guard every run."""
    return [
        not_null("silver_geolocation", "geolocation_zip_code_prefix"),
        unique("dim_customers", "customer_id"),
        not_null("dim_customers", "customer_id"),
        not_null("dim_customers", "customer_unique_id"),
        unique("dim_orders", "order_id"),
        not_null("dim_orders", "order_id"),
        accepted_values("dim_orders", "order_status", statuses),
        not_null("fact_order_items", "order_id"),
        not_null("fact_order_items", "order_item_id"),
        not_null("fact_order_items", "price"),
    ]


def key_checks() -> list[Check]:
    """Further keys the questions rely on."""
    return [
        unique("dim_products", "product_id"),
        unique("dim_sellers", "seller_id"),
        unique("fact_order_items", "order_item_key"),
    ]


def value_checks() -> list[Check]:
    return [expression("fact_order_items", "item_revenue", "item_revenue > 0")]
