"""The whole chain, from CSV files to tables, tests, predictions and views."""

import csv
from pathlib import Path

import pytest
from helpers import SHOP, settings, tuples

from shopmart.plans import jobs, marts
from shopmart.schemas import GOLD_TABLES, RAW_SCHEMAS, RAW_TABLES
from shopmart.sinks import catalog, versions


def write_shop(folder, orders, items):
    folder.mkdir()
    tables = {**SHOP, "orders": orders, "order_items": items}
    # Rows that the declared tests would stop.
    tables["geolocation"] = [row for row in SHOP["geolocation"] if row[0] is not None]
    for name, rows in tables.items():
        with open(folder / f"acme_{name}_dataset.csv", "w", newline="") as file:
            writer = csv.writer(file)
            writer.writerow(RAW_SCHEMAS[name].fieldNames())
            writer.writerows(rows)


@pytest.fixture
def orders():
    from datetime import timedelta

    first = next(row for row in SHOP["orders"] if row[0] == "o2")
    bought, due = first[3], first[7]
    return [
        (f"n{i}", "c1", "delivered", bought + timedelta(days=i), None, None,
         due + timedelta(days=i + (3 if i % 3 == 0 else -1)), due + timedelta(days=i + i % 4))
        for i in range(120)
    ]


def test_run_all(spark, tmp_path, orders):
    items = [(o[0], 1, "p1", "s1", "10.00", "1.00") for o in orders]
    dst = str(tmp_path / "dst")
    write_shop(tmp_path / "one", orders, items)
    summary = jobs.run_all(spark, str(tmp_path / "one"), dst, "run_raw", "run_dw", coalesce=1)
    assert set(summary.rows) == {*RAW_TABLES, jobs.SILVER, jobs.MEASURES, *GOLD_TABLES, jobs.SUMMARY}
    assert summary.rows["orders"] == summary.rows["fact_order_items"] == 120
    assert summary.rows[jobs.SILVER] == 2
    assert 0.0 <= summary.auc <= 1.0
    predictions = catalog.read_table(spark, "run_dw", jobs.PREDICTIONS)
    assert dict(predictions.dtypes)["probability"] == "array<double>"
    by_path = spark.newSession().read.parquet(f"{dst}/warehouse/{summary.version}/{jobs.PREDICTIONS}")
    assert by_path.count() == predictions.count()
    assert not (Path.cwd() / "spark-warehouse").exists()
    assert 0 < predictions.count() < 120
    assert tuple(spark.table("dw_joined").columns) == marts.JOINED_COLUMNS
    assert spark.table("dw_joined").count() == 120
    assert spark.table("dw_payments_joined").count() == 6
    total = spark.sql("SELECT sum(item_revenue) AS s FROM run_dw.fact_order_items").first().s
    assert float(total) == 1320.0

    # A second run replaces everything.
    write_shop(tmp_path / "two", orders[:60], items)
    again = jobs.run_all(
        spark, str(tmp_path / "two"), dst, "run_raw", "run_dw", multi_line=["order_reviews"]
    )
    assert again.rows["dim_orders"] == again.rows["fact_order_items"] == 60
    fact = catalog.read_table(spark, "run_dw", "fact_order_items")
    assert fact.count() == spark.table("dw_joined").count() == 60


def small_items(orders):
    return [(o[0], 1, "p1", "s1", "10.00", "1.00") for o in orders]


def state(spark, raw, gold):
    """What readers see of the orders, the fact, the predictions and the views."""
    return {
        name: sorted(map(str, spark.table(name).collect()))
        for name in (
            f"{raw}.orders", f"{gold}.dim_orders", f"{gold}.fact_order_items",
            f"{gold}.{jobs.PREDICTIONS}", f"{gold}.dw_joined", f"{gold}.dw_payments_joined",
        )
    }


class Killed(BaseException):
    """Ends a job as a signal would."""


def test_a_run_that_ends_early_leaves_the_old_tables(spark, tmp_path, orders, monkeypatch):
    """A failing test, and a kill while building, training or before publishing; then one in the middle of it."""
    raw, gold, dst = "old_raw", "old_dw", str(tmp_path / "dst")

    def run(name, some, **options):
        write_shop(tmp_path / name, some, small_items(orders))
        return jobs.run_all(spark, str(tmp_path / name), dst, raw, gold, **options)

    def killed(*_, **__):
        raise Killed

    run("one", orders)
    before = state(spark, raw, gold)
    places = {
        "build": (jobs.gold, "dim_payments"),
        "train": (jobs.delivery_model, "train"),
        "publish": (jobs.versions, "publish"),
    }
    with pytest.raises(jobs.QualityError, match="dim_orders.order_id unique: 1"):
        run("test", [*orders[:50], orders[0]])
    for stage, place in places.items():
        monkeypatch.setattr(*place, killed)
        with pytest.raises(Killed):
            run(stage, orders[:50])
        monkeypatch.undo()
    spark.catalog.clearCache()
    assert state(spark, raw, gold) == before

    point = catalog.point_table

    def stops_at_the_fact(session, database, table, path):
        if table == "fact_order_items":
            raise Killed
        point(session, database, table, path)

    monkeypatch.setattr(catalog, "point_table", stops_at_the_fact)
    with pytest.raises(Killed):
        run("middle", orders[:50])
    monkeypatch.undo()
    assert spark.table(f"{gold}.dim_orders").count() == 50
    assert spark.table(f"{gold}.fact_order_items").count() == 120
    # A version in use is never deleted, however old.
    in_use = [catalog.location(spark, gold, t) for t in ("dim_orders", "fact_order_items")]
    used = {x.rsplit("/", 2)[1] for x in in_use}
    versions.expire(spark, f"{dst}/warehouse", 1, in_use)
    assert {p.name for p in (tmp_path / "dst" / "warehouse").iterdir()} == used and len(used) == 2
    assert spark.table(f"{gold}.fact_order_items").count() == 120

    # The next run needs no repair. It writes buckets, so that the view's first join has no shuffle.
    last = run("last", orders[:40], keep_versions=1, buckets=4, statistics=True)
    kept = sorted(p.name for p in (tmp_path / "dst" / "warehouse").iterdir())
    assert kept == [last.version] and spark.table(f"{gold}.fact_order_items").count() == 40
    assert not [t for t in spark.catalog.listTables(gold) if t.name.startswith("scratch")]
    join = f"SELECT * FROM {gold}.fact_order_items f LEFT JOIN {gold}.dim_orders o ON f.order_id = o.order_id"
    no_broadcast = {
        "spark__sql__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    }
    with settings(spark, **no_broadcast):
        plan = spark.sql(join)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
    assert spark.sql(join).count() == 40
    check_views(spark, gold)
    with pytest.raises(ValueError, match="at least one"):
        versions.expire(spark, dst, 0)
    assert versions.expire(spark, f"{dst}/nowhere", 1) == []


def check_views(spark, gold):
    """Another session reads the views by their qualified names, and they are the plans of the library."""
    other = spark.newSession()
    assert not [t.name for t in other.catalog.listTables() if t.isTemporary]
    tables = {t: catalog.read_table(spark, gold, t) for t in GOLD_TABLES}
    lines = marts.with_order(tables["fact_order_items"], tables["dim_orders"], tables["dim_customers"])
    frame = marts.dw_joined(lines, tables["dim_products"], tables["dim_sellers"])
    assert tuples(other.table(f"{gold}.dw_joined")) == tuples(frame)
    frame = marts.dw_payments_joined(tables["dim_payments"], tables["dim_orders"])
    assert tuples(other.table(f"{gold}.dw_payments_joined")) == tuples(frame)


def test_star_join_order_follows_statistics(spark, tmp_path):
    """The fact meets the smallest dimension first once its size and keys are known."""
    catalog.create_database(spark, "stats_dw")
    spark.range(20_000).selectExpr("id AS k", "id % 5000 AS big", "id % 10 AS small").write.parquet(str(tmp_path / "f"))
    spark.range(5000).selectExpr("id AS big", "repeat('x', 50) AS v").write.parquet(str(tmp_path / "b"))
    spark.range(2).selectExpr("id AS small", "repeat('y', 50) AS w").write.parquet(str(tmp_path / "s"))
    keys = {"f": ("k", "big", "small"), "b": ("big",), "s": ("small",)}
    for name in keys:
        catalog.point_table(spark, "stats_dw", name, str(tmp_path / name))
    sql = "SELECT f.k, b.v, s.w FROM stats_dw.f JOIN stats_dw.b USING (big) JOIN stats_dw.s USING (small)"

    def innermost():
        plan = spark.sql(sql)._jdf.queryExecution().optimizedPlan().toString()
        joins = [line.split("Join Inner, (")[1].split("#")[0] for line in plan.splitlines() if "Join Inner" in line]
        return joins[-1]

    with settings(spark, spark__sql__cbo__enabled="true", spark__sql__cbo__joinReorder__enabled="true"):
        assert innermost() == "big"
        for name, columns in keys.items():
            catalog.analyze(spark, "stats_dw", name, columns)
        assert innermost() == "small"
        assert spark.sql(sql).count() == 4000


def test_tables_are_switched_or_registered_anew(spark, tmp_path):
    one, two, other = (str(tmp_path / x) for x in ("it's one", "two", "other"))
    spark.range(3).write.parquet(one)
    spark.range(5).write.parquet(two)
    spark.range(7).selectExpr("id AS n").write.parquet(other)
    catalog.create_database(spark, "point_dw")
    for path, rows in ((one, 3), (two, 5), (other, 7), (one, 3)):
        catalog.point_table(spark, "point_dw", "t", path)
        assert spark.table("point_dw.t").count() == rows
    assert catalog.location(spark, "point_dw", "t").endswith("one")


def test_failing_test_stops_the_chain(spark, tmp_path, orders):
    write_shop(tmp_path / "src", [*orders, orders[0]], [])
    with pytest.raises(jobs.QualityError, match="dim_orders.order_id unique: 1"):
        jobs.run_all(spark, str(tmp_path / "src"), str(tmp_path / "dst"), "bad_raw", "bad_dw")
    with pytest.raises(LookupError):
        catalog.read_table(spark, "bad_dw", jobs.PREDICTIONS)


def test_predictions_table(spark, tmp_path, orders):
    names = RAW_SCHEMAS["orders"]
    orders_path, dst = str(tmp_path / "orders"), str(tmp_path / "dst")
    catalog.save_table(spark.createDataFrame(orders, names), "ml_dw", "dim_orders", orders_path)
    auc = jobs.train_model(spark, "ml_dw", dst)
    again = jobs.train_model(spark, "ml_dw", dst)
    table = catalog.read_table(spark, "ml_dw", jobs.PREDICTIONS)
    assert table.columns == [
        "order_id", "customer_id", "is_delayed", "predicted_delay", "probability"
    ]
    assert spark.read.parquet(f"{dst}/{jobs.PREDICTIONS}").count() == table.count()
    assert auc == again and table.count() == table.select("order_id").distinct().count() > 0


def test_repeated_key_of_a_dimension_stops_the_chain(spark, tmp_path, orders, monkeypatch):
    items = [(o[0], 1, "p1", "s1", "10.00", "1.00") for o in orders]
    repeats = {"products": "dim_products", "sellers": "dim_sellers", jobs.TRANSLATION: jobs.TRANSLATION}
    for raw, model in repeats.items():
        monkeypatch.setitem(SHOP, raw, [*SHOP[raw], SHOP[raw][0]])
        write_shop(tmp_path / raw, orders, items)
        with pytest.raises(jobs.QualityError, match=f"{model}.* unique"):
            jobs.run_all(spark, str(tmp_path / raw), str(tmp_path / f"{raw}-dst"), "key_raw", "key_dw")
        monkeypatch.undo()


def test_training_needs_its_table(spark, tmp_path):
    with pytest.raises(LookupError, match="nowhere.dim_orders"):
        jobs.train_model(spark, "nowhere", str(tmp_path))
