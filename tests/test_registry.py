"""Registered queries: equal to their SQL, and planned as intended."""

import pytest
from oracle_check import connect, duck_rows, spark_rows

import __spark_entry__ as entry_point
from shopmart import oracle, queries

QUERIES = queries.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_small):
    con = connect(sf_small)
    yield con
    con.close()


TRAINED = {"ml_predictions", "ml_auc", "ml_library_fit"}


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, sf_small, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf_small))
    expected_columns, expected = duck_rows(duck, SQL[name])
    assert columns == expected_columns
    assert rows == expected


def test_model_output(spark, sf_small):
    predictions = QUERIES["ml_predictions"](spark, sf_small)
    auc = QUERIES["ml_auc"](spark, sf_small).first()
    assert predictions.count() == auc.n_rows > 0
    assert 0.0 <= auc.auc <= 1.0


def test_entry(spark, sf_small):
    assert entry_point.entry(spark).columns == ["order_month", "revenue"]


def test_building_a_query_starts_no_job(spark, sf_small):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "building queries")
    try:
        for name in set(QUERIES) - TRAINED - {"ml_auc_stated"}:
            QUERIES[name](spark, sf_small)
        assert list(tracker.getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setJobGroup(None, None)


def plan_of(spark, sf, name):
    return QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(SQL))
def test_no_pairing_and_no_python(spark, sf_small, name):
    plan = plan_of(spark, sf_small, name)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Window"):
        assert word not in plan


@pytest.mark.parametrize(
    ("name", "columns", "absent"),
    [
        ("bi_orders_over_time", "struct<o_orderdate:timestamp_ntz>", "lineitem"),
        ("bi_order_status", "struct<o_orderstatus:string>", "lineitem"),
        ("bi_top_products", "struct<l_partkey:bigint,l_extendedprice:double>", "orders.parquet"),
        ("bi_monthly_revenue", "struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>", "l_shipdate"),
        ("bi_sales_by_state", "struct<o_orderkey:bigint,o_custkey:bigint>", "l_shipdate"),
        ("bi_top_sellers", "struct<o_orderkey:bigint>", "events"),
    ],
)
def test_only_needed_columns_are_read(spark, sf_small, name, columns, absent):
    plan = plan_of(spark, sf_small, name)
    assert columns in plan
    assert absent not in plan


def test_ranked_cuts_do_not_sort_everything(spark, sf_small):
    for name in ("bi_top_products", "bi_top_sellers", "bi_revenue_by_category"):
        plan = plan_of(spark, sf_small, name)
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
