"""Silver and gold models against results worked out by hand."""

from decimal import Decimal

import pytest
from helpers import tuples

from shopmart.plans.gold import fact_order_items, reviews_per_order
from shopmart.plans.silver import silver_geolocation
from shopmart.schemas import FACT_COLUMNS


def test_centroid_per_zip(gold):
    rows = {r[0]: r[1:] for r in tuples(gold["silver_geolocation"])}
    assert set(rows) == {None, "01037", "20000"}
    lat, lng, city, state = rows["01037"]
    assert lat == pytest.approx((-23.5 * 2 - 23.2) / 3)
    assert lng == pytest.approx((-46.6 * 2 - 46.0) / 3)
    # The alphabetically first place; capital letters sort before small ones.
    assert (city, state) == ("São Paulo", "SP")
    assert rows[None] == (1.0, 2.0, "nowhere", "XX")


def test_first_place_follows_the_given_order(spark):
    rows = [("1", 1.0, None, "b", "B", 1), ("1", None, None, "a", "A", 2)]
    geo = spark.createDataFrame(
        rows,
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string, seen int",
    )
    assert tuples(silver_geolocation(geo, first_by="seen")) == [("1", 1.0, None, "b", "B")]
    assert tuples(silver_geolocation(geo)) == [("1", 1.0, None, "a", "A")]


def test_named_place_wins_over_missing_name(spark):
    rows = [("1", 1.0, 1.0, None, "A"), ("1", 1.0, 1.0, "x", "B")]
    geo = spark.createDataFrame(
        rows,
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string",
    )
    assert tuples(silver_geolocation(geo), "city", "state") == [("x", "B")]


def test_customers_keep_rows_without_coordinates(gold):
    rows = tuples(gold["dim_customers"], "customer_id", "customer_latitude", "customer_longitude")
    assert [r[0] for r in rows] == ["c1", "c2", "c3", "c4"]
    assert rows[1][1:] == (-22.9, -43.2)
    assert rows[2][1:] == rows[3][1:] == (None, None)


def test_sellers_keep_rows_without_coordinates(gold):
    rows = tuples(gold["dim_sellers"], "seller_id", "seller_latitude")
    assert rows[0][1] == pytest.approx(-23.4)
    assert rows[1] == ("s2", None)


def test_products_keep_untranslated_categories(gold):
    rows = tuples(
        gold["dim_products"], "product_id", "product_category_name", "product_category_name_english"
    )
    assert rows == [("p1", "beleza", "beauty"), ("p2", "sem_traducao", None), ("p3", None, None)]
    assert len(gold["dim_products"].columns) == 10


def test_projections(gold):
    assert len(gold["dim_orders"].columns) == 8
    assert gold["dim_payments"].columns == [
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ]


def test_reviews_are_averaged(shop):
    rows = tuples(reviews_per_order(shop["order_reviews"]))
    assert rows == [("o1", 3.5), ("o2", 4.0), ("o6", 1.0), ("zz", 3.0)]


def test_fact(gold):
    fact = gold["fact_order_items"]
    assert tuple(fact.columns) == FACT_COLUMNS
    rows = {r.order_item_key: r for r in fact.collect()}
    # Two reviews do not repeat the items; the item without an order is gone.
    assert sorted(rows) == ["o1_1", "o1_2", "o2_1", "o3_1", "o4_1", "o6_1", "o7_1"]
    assert rows["o1_1"].item_revenue == Decimal("11.50")
    assert rows["o1_2"].review_score == 3.5
    assert rows["o1_1"].delivery_time_days == 1
    assert rows["o2_1"].item_revenue is None
    assert rows["o2_1"].delivery_time_days == 10
    assert rows["o3_1"].delivery_time_days is None
    assert rows["o3_1"].review_score is None
    assert rows["o6_1"].delivery_time_days == -2
    assert rows["o7_1"].customer_id == "c9"


def test_results_do_not_depend_on_partitioning(shop, gold):
    again = fact_order_items(
        shop["order_items"].repartition(7),
        shop["orders"].repartition(3),
        shop["order_reviews"].repartition(5),
    )
    assert tuples(again) == tuples(gold["fact_order_items"])
    geo = silver_geolocation(shop["geolocation"].repartition(5))
    assert [r[3:] for r in tuples(geo)] == [r[3:] for r in tuples(gold["silver_geolocation"])]
