"""Gold layer: five dimensions and the order-item fact.

Every function maps DataFrames to a DataFrame, so the same plan runs on
ingested files, on registered tables and on test tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.functions.columns import days_between, item_revenue, order_item_key
from shopmart.operators.joins import spread_join
from shopmart.plans.silver import ZIP
from shopmart.schemas import FACT_COLUMNS, PRODUCT_SIZES, RAW_SCHEMAS


def _locate(df: DataFrame, geo: DataFrame, role: str) -> DataFrame:
    """Centroid columns for customers or sellers; NULL where the prefix is unknown."""
    zip_column = f"{role}_zip_code_prefix"
    centroids = geo.select(
        F.col(ZIP).alias(zip_column),
        F.col("latitude").alias(f"{role}_latitude"),
        F.col("longitude").alias(f"{role}_longitude"),
    )
    return df.join(centroids, zip_column, "left")


def dim_customers(customers: DataFrame, geo: DataFrame) -> DataFrame:
    columns = RAW_SCHEMAS["customers"].fieldNames()
    return _locate(customers.select(*columns), geo, "customer").select(
        *columns, "customer_latitude", "customer_longitude"
    )


def dim_sellers(sellers: DataFrame, geo: DataFrame) -> DataFrame:
    columns = RAW_SCHEMAS["sellers"].fieldNames()
    return _locate(sellers.select(*columns), geo, "seller").select(
        *columns, "seller_latitude", "seller_longitude"
    )


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category, NULL where it is untranslated.

    Spark broadcasts the translation if its size allows that, and else splits
    a frequent category itself, as both sides are shuffled for this join only.
    """
    english = translation.select("product_category_name", "product_category_name_english")
    return products.join(english, "product_category_name", "left").select(
        "product_id", "product_category_name", "product_category_name_english", *PRODUCT_SIZES
    )


def dim_orders(orders: DataFrame) -> DataFrame:
    return orders.select(*RAW_SCHEMAS["orders"].fieldNames())


def dim_payments(payments: DataFrame) -> DataFrame:
    return payments.select(*RAW_SCHEMAS["order_payments"].fieldNames())


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    """Mean score per order, so that several reviews do not repeat the items."""
    return reviews.groupBy("order_id").agg(F.avg("review_score").alias("review_score"))


def order_measures(orders: DataFrame, reviews: DataFrame, *carry: str) -> DataFrame:
    """What an item takes from its order, at one row per order.

    Joined here, orders and reviews meet at the size of the orders; the items,
    the largest table, are then shuffled once instead of twice.
    """
    delivery_days = days_between(
        F.col("order_delivered_customer_date"), F.col("order_purchase_timestamp")
    )
    return orders.select(
        "order_id", "customer_id", delivery_days.alias("delivery_time_days"), *carry
    ).join(reviews_per_order(reviews), "order_id", "left")


def item_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items whose order exists, with their revenue and nothing from the order."""
    return spread_join(with_revenue(items), orders.select("order_id"), "order_id")


def with_revenue(items: DataFrame) -> DataFrame:
    return items.withColumn("item_revenue", item_revenue(F.col("price"), F.col("freight_value")))


def item_rows(items: DataFrame) -> DataFrame:
    """The declared columns of the items."""
    return items.select(*RAW_SCHEMAS["order_items"].fieldNames())


def with_derived(rows: DataFrame) -> DataFrame:
    """Items with what follows from their own columns; added after the last shuffle, it does not travel."""
    key = order_item_key(F.col("order_id"), F.col("order_item_id"))
    return with_revenue(rows).withColumn("order_item_key", key)


def sales_lines(items: DataFrame, measures: DataFrame) -> DataFrame:
    """Items with their order's measures; an item without an order is dropped.

    An order with very many items is dealt out over several tasks.
    """
    return with_derived(spread_join(item_rows(items), measures, "order_id"))


def fact_order_items(items: DataFrame, orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per order item."""
    return sales_lines(items, order_measures(orders, reviews)).select(*FACT_COLUMNS)
