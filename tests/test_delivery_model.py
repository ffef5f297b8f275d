from datetime import datetime, timedelta

import pytest
from helpers import tuples
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shopmart.plans import delivery_model as model


@pytest.fixture(scope="module")
def history(spark):
    """Orders whose delay depends on the promised days.

    In a session of its own: a fitted model carries its session along, and
    Spark cannot ship one that has observed a write.
    """
    n = 3000
    start = datetime(2017, 1, 1)
    rows = []
    for i in range(n):
        bought = start + timedelta(days=i % 50)
        promised = 3 + (i * 7) % 25
        took = 5 + (i * 13) % 20
        delivered, estimated = bought + timedelta(days=took), bought + timedelta(days=promised)
        rows.append((f"o{i}", f"c{i % 90}", bought, delivered, estimated))
    names = [
        "order_id",
        "customer_id",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ]
    return spark.newSession().createDataFrame(rows, names)


def assembled(df):
    return VectorAssembler(inputCols=model.FEATURES, outputCol="features").transform(df)


def test_features_of_the_shop(shop):
    rows = tuples(
        model.delay_features(shop["orders"]), "order_id", model.LABEL, *model.FEATURES
    )
    # o5 has no estimate. Sunday is day 1; 2017-01-31 was a Tuesday.
    assert rows == [
        ("o1", 1, 0, 3),
        ("o2", 0, 15, 6),
        ("o3", 0, 14, 4),
        ("o4", 0, 4, 4),
        ("o6", 0, 10, 6),
        ("o7", 0, 9, 7),
    ]


def test_undelivered_orders_can_be_left_out(shop):
    rows = tuples(model.delay_features(shop["orders"], delivered_only=True), "order_id")
    assert [r[0] for r in rows] == ["o1", "o2", "o4", "o6"]


def test_split_is_a_partition_and_stable(history):
    features = model.delay_features(history)
    train, test = model.split(features)
    ids = {r.order_id for r in train.select("order_id").collect()}
    rest = {r.order_id for r in test.select("order_id").collect()}
    assert not ids & rest and len(ids | rest) == 3000
    assert 0.75 < len(ids) / 3000 < 0.85
    again, _ = model.split(features.repartition(7))
    assert {r.order_id for r in again.select("order_id").collect()} == ids


def test_training_equals_the_library_even_if_it_has_not_converged(history, monkeypatch):
    monkeypatch.setattr(model, "MAX_ITERATIONS", 10)
    features = model.delay_features(history)
    # One combination dominates, so that ten iterations are not enough.
    first = features.limit(1)
    features = features.unionByName(first.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(5000)))).drop("copy"))
    weighted = model.train(features)
    single = LogisticRegression(featuresCol="features", labelCol=model.LABEL, maxIter=10).fit(
        assembled(features)
    )
    assert weighted.coefficients.toArray() == pytest.approx(single.coefficients.toArray(), rel=1e-9)
    assert weighted.intercept == pytest.approx(single.intercept, rel=1e-9)


def test_predictions_and_auc(history):
    train, test = model.split(model.delay_features(history))
    fitted = model.train(train)
    predictions = model.predict(fitted, test)
    assert predictions.columns == [
        "order_id", "customer_id", "is_delayed", "predicted_delay", "probability"
    ]
    assert predictions.count() == test.count()
    expected = fitted.transform(assembled(test)).select(
        "order_id", "prediction", vector_to_array("probability").alias("p")
    )
    apart = predictions.join(expected, "order_id").where(
        (F.col("predicted_delay") != F.col("prediction"))
        | (F.abs(F.col("probability")[0] - F.col("p")[0]) > 1e-12)
        | (F.abs(F.col("probability")[1] - F.col("p")[1]) > 1e-12)
    )
    assert apart.isEmpty()
    auc = model.area_under_roc(fitted, test)
    assert 0.7 < auc <= 1.0
    single = BinaryClassificationEvaluator(labelCol=model.LABEL).evaluate(
        fitted.transform(assembled(test))
    )
    assert auc == pytest.approx(single)
