"""The driver's TPC-H-like tables, seen as the nine raw tables.

Columns are computed by Spark from the given files; nothing is made up but the
five translations. ``oracle.py`` states the same mapping in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Every part type but PROMO is translated.
TRANSLATED_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD")

# Order priorities stand in for payment types.
PAYMENT_TYPES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")

# The statuses are F, O and P; leaving out P makes the test fail.
ACCEPTED_STATUSES = ("F", "O")

# Column that orders the rows of a zip prefix in the geolocation stand-in.
FIRST_BY = "row_key"


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(12,2)")


# Declared, so that no job is needed to find the columns of a file.
_FILE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
        "props string"
    ),
}


class RawTables:
    """Raw tables of one scale folder, each built once, when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._built: dict[str, DataFrame] = {}

    def scan(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(_FILE_SCHEMAS[name])
        return reader.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = _BUILDERS[name](self)
        return self._built[name]

    def all(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in _BUILDERS}


def _orders(raw: RawTables) -> DataFrame:
    shipped = raw.scan("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("order_delivered_carrier_date"),
        F.max("l_shipdate").alias("order_delivered_customer_date"),
    )
    return raw.scan("orders").join(shipped, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.expr("o_orderdate + make_dt_interval(1)").alias("order_approved_at"),
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        F.expr("o_orderdate + make_dt_interval(cast(30 + o_orderkey % 60 as int))").alias(
            "order_estimated_delivery_date"
        ),
    )


def _order_items(raw: RawTables) -> DataFrame:
    price = _money("l_extendedprice")
    return raw.scan("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        price.alias("price"),
        (F.col("l_tax").cast("decimal(4,2)") * price).alias("freight_value"),
    )


def _customers(raw: RawTables) -> DataFrame:
    nation = raw.scan("nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_state")
    )
    return raw.scan("customer").join(nation, "c_nationkey", "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        "customer_state",
    )


def _sellers(raw: RawTables) -> DataFrame:
    nation = raw.scan("nation").join(
        raw.scan("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    place = nation.select(
        F.col("n_nationkey").alias("s_nationkey"),
        F.col("n_name").alias("seller_city"),
        F.col("r_name").alias("seller_state"),
    )
    return raw.scan("supplier").join(place, "s_nationkey", "left").select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").alias("seller_zip_code_prefix"),
        "seller_city",
        "seller_state",
    )


def _geolocation(raw: RawTables) -> DataFrame:
    # Prefixes are shifted, so that 0 to 4 are left unknown on purpose: their
    # customers and sellers get no coordinates.
    nation = raw.scan("nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("geolocation_state")
    )
    return raw.scan("customer").join(nation, "c_nationkey", "left").select(
        (F.col("c_nationkey") + 5).alias("geolocation_zip_code_prefix"),
        _money("c_acctbal").alias("geolocation_lat"),
        F.col("c_custkey").alias("geolocation_lng"),
        F.col("c_mktsegment").alias("geolocation_city"),
        "geolocation_state",
        F.col("c_custkey").alias(FIRST_BY),
    )


def _products(raw: RawTables) -> DataFrame:
    none = F.lit(None).cast("int")
    return raw.scan("part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        none.alias("product_description_lenght"),
        none.alias("product_photos_qty"),
        F.col("p_size").alias("product_weight_g"),
        none.alias("product_length_cm"),
        none.alias("product_height_cm"),
        none.alias("product_width_cm"),
    )


def _translation(raw: RawTables) -> DataFrame:
    # Literal rows in SQL are a local relation, whose size Spark knows.
    rows = ", ".join(f"('{name}', '{name.lower()}')" for name in TRANSLATED_TYPES)
    return raw.spark.sql(
        f"SELECT * FROM VALUES {rows} AS t(product_category_name, product_category_name_english)"
    )


def _order_payments(raw: RawTables) -> DataFrame:
    return raw.scan("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        F.col("o_orderpriority").alias("payment_type"),
        F.expr("cast(1 + o_orderkey % 12 as int)").alias("payment_installments"),
        _money("o_totalprice").alias("payment_value"),
    )


def _order_reviews(raw: RawTables) -> DataFrame:
    return raw.scan("events").select(
        F.expr("event_id div 2").alias("order_id"),
        F.expr("cast(1 + user_id % 5 as int)").alias("review_score"),
    )


_BUILDERS: dict[str, Callable[[RawTables], DataFrame]] = {
    "customers": _customers,
    "geolocation": _geolocation,
    "order_items": _order_items,
    "order_payments": _order_payments,
    "order_reviews": _order_reviews,
    "orders": _orders,
    "products": _products,
    "sellers": _sellers,
    "product_category_name_translation": _translation,
}
