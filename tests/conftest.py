"""A local session and the tables of the hand-made shop."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from helpers import SHOP  # noqa: E402

from shopmart.schemas import RAW_SCHEMAS  # noqa: E402
from shopmart.session import build_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_spark(
        app_name="tests",
        master="local[4]",
        shuffle_partitions=4,
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(warehouse),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def shop(spark):
    return {
        name: spark.createDataFrame(rows, RAW_SCHEMAS[name]) for name, rows in SHOP.items()
    }


@pytest.fixture(scope="session")
def gold(shop):
    from shopmart.plans import gold as g
    from shopmart.plans.silver import silver_geolocation

    geo = silver_geolocation(shop["geolocation"])
    return {
        "silver_geolocation": geo,
        "dim_customers": g.dim_customers(shop["customers"], geo),
        "dim_sellers": g.dim_sellers(shop["sellers"], geo),
        "dim_products": g.dim_products(
            shop["products"], shop["product_category_name_translation"]
        ),
        "dim_orders": g.dim_orders(shop["orders"]),
        "dim_payments": g.dim_payments(shop["order_payments"]),
        "fact_order_items": g.fact_order_items(
            shop["order_items"], shop["orders"], shop["order_reviews"]
        ),
    }


@pytest.fixture(scope="session")
def sf_small():
    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("test tables are not available")
    return str(folder)
