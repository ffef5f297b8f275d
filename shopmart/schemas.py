"""Declared types of the raw tables and column lists of the tables built from them."""

from __future__ import annotations

from pyspark.sql import types as T

_STR = T.StringType()
_INT = T.IntegerType()
_DBL = T.DoubleType()
_TS = T.TimestampType()
# Money is exact, so that sums do not depend on the order of the rows.
_MONEY = T.DecimalType(12, 2)


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns])


# Columns every source file of the table must have. Zip prefixes are strings:
# inferred as integers they would lose their leading zeros.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "customers": _table(
        ("customer_id", _STR),
        ("customer_unique_id", _STR),
        ("customer_zip_code_prefix", _STR),
        ("customer_city", _STR),
        ("customer_state", _STR),
    ),
    "geolocation": _table(
        ("geolocation_zip_code_prefix", _STR),
        ("geolocation_lat", _DBL),
        ("geolocation_lng", _DBL),
        ("geolocation_city", _STR),
        ("geolocation_state", _STR),
    ),
    "order_items": _table(
        ("order_id", _STR),
        ("order_item_id", _INT),
        ("product_id", _STR),
        ("seller_id", _STR),
        ("price", _MONEY),
        ("freight_value", _MONEY),
    ),
    "order_payments": _table(
        ("order_id", _STR),
        ("payment_sequential", _INT),
        ("payment_type", _STR),
        ("payment_installments", _INT),
        ("payment_value", _MONEY),
    ),
    "order_reviews": _table(
        ("order_id", _STR),
        ("review_score", _INT),
    ),
    "orders": _table(
        ("order_id", _STR),
        ("customer_id", _STR),
        ("order_status", _STR),
        ("order_purchase_timestamp", _TS),
        ("order_approved_at", _TS),
        ("order_delivered_carrier_date", _TS),
        ("order_delivered_customer_date", _TS),
        ("order_estimated_delivery_date", _TS),
    ),
    "products": _table(
        ("product_id", _STR),
        ("product_category_name", _STR),
        # The misspelling is part of the column name.
        ("product_name_lenght", _INT),
        ("product_description_lenght", _INT),
        ("product_photos_qty", _INT),
        ("product_weight_g", _INT),
        ("product_length_cm", _INT),
        ("product_height_cm", _INT),
        ("product_width_cm", _INT),
    ),
    "sellers": _table(
        ("seller_id", _STR),
        ("seller_zip_code_prefix", _STR),
        ("seller_city", _STR),
        ("seller_state", _STR),
    ),
    "product_category_name_translation": _table(
        ("product_category_name", _STR),
        ("product_category_name_english", _STR),
    ),
}

RAW_TABLES = tuple(RAW_SCHEMAS)

# Times that source files may hold besides; other further columns are text.
OPTIONAL_TYPES: dict[str, T.DataType] = {
    "shipping_limit_date": _TS,
    "review_creation_date": _TS,
    "review_answer_timestamp": _TS,
}

PRODUCT_SIZES = tuple(RAW_SCHEMAS["products"].fieldNames()[2:])

# Names and columns of the models.
GOLD_TABLES = (
    "dim_customers",
    "dim_products",
    "dim_sellers",
    "dim_orders",
    "dim_payments",
    "fact_order_items",
)

FACT_COLUMNS = (
    "order_item_key",
    "order_id",
    "order_item_id",
    "product_id",
    "seller_id",
    "customer_id",
    "price",
    "freight_value",
    "item_revenue",
    "delivery_time_days",
    "review_score",
)

# The states an order may be in.
ORDER_STATUSES = (
    "delivered",
    "shipped",
    "invoiced",
    "processing",
    "created",
    "unavailable",
    "canceled",
    "approved",
)
