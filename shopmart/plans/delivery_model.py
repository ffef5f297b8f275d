"""Late-delivery classifier on spark.ml."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.functions.columns import days_between, delayed_flag

FEATURES = ["estimated_duration_days", "purchase_day_of_week"]
LABEL = "is_delayed"
# One bucket is a tenth of the orders; the first eight train the model.
BUCKETS = 10
TRAIN_BUCKETS = 8
SPLIT_SEED = 42
MAX_ITERATIONS = 10
NEWTON_STEPS, NEWTON_STEP = 25, 1e-10


def delay_features(orders: DataFrame, delivered_only: bool = False) -> DataFrame:
    """Orders with label and features; rows that lack one of them are dropped.

    An order that was not delivered counts as not delayed, unless
    ``delivered_only`` leaves such orders out.
    """
    delivered, estimated = "order_delivered_customer_date", "order_estimated_delivery_date"
    purchased = F.col("order_purchase_timestamp")
    if delivered_only:
        orders = orders.where(F.col(delivered).isNotNull())
    return orders.withColumns(
        {
            LABEL: delayed_flag(F.col(delivered), F.col(estimated)),
            FEATURES[0]: days_between(F.col(estimated), purchased),
            FEATURES[1]: F.dayofweek(purchased),
        }
    ).na.drop(subset=[*FEATURES, LABEL])


def hash_bucket(key: str = "order_id") -> Column:
    """Bucket of an order by a hash of its id, the same however rows are partitioned."""
    return F.pmod(F.xxhash64(F.lit(SPLIT_SEED), F.col(key)), F.lit(BUCKETS))


def split(features: DataFrame, bucket: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Train and test orders, about 80 to 20. ``bucket`` is a number below ten per order."""
    bucket = hash_bucket() if bucket is None else bucket
    return features.where(bucket < TRAIN_BUCKETS), features.where(bucket >= TRAIN_BUCKETS)


def _weighted(features: DataFrame) -> DataFrame:
    """Distinct combinations of features and label with their number of orders."""
    return features.groupBy(*FEATURES, LABEL).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def train(features: DataFrame) -> LogisticRegressionModel:
    """Logistic regression on the two features of every order.

    The features, two small numbers and the label, are kept for the length of the fit,
    which reads them once per iteration; the iterations are distributed.
    """
    stages = [
        VectorAssembler(inputCols=FEATURES, outputCol="features"),
        LogisticRegression(
            featuresCol="features", labelCol=LABEL, maxIter=MAX_ITERATIONS
        ),
    ]
    rows = features.select(*FEATURES, LABEL).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=stages).fit(rows).stages[-1]
    finally:
        rows.unpersist()


@dataclass(frozen=True)
class Linear:
    """A model of known coefficients, to score with as with a fitted one."""

    intercept: float
    coefficients: tuple[float, ...]
    threshold: float = 0.5

    def getThreshold(self) -> float:  # noqa: N802
        return self.threshold


def train_exact(features: DataFrame) -> Linear:
    """The maximum of the likelihood that ``train`` climbs towards, by Newton steps to convergence.

    Orders are counted by features and label once, which leaves a row per combination of two small
    numbers; every step sums the gradient and the curvature over these rows and sends nine numbers to the driver.
    Where labels can be told apart without an error there is no maximum, and the last step counts.
    """
    rows = _weighted(features).persist(StorageLevel.MEMORY_AND_DISK)
    names = [None, *FEATURES]
    weights = np.zeros(len(names))
    try:
        for _ in range(NEWTON_STEPS):
            at = Linear(float(weights[0]), tuple(map(float, weights[1:])))
            delayed = F.lit(1.0) / (F.lit(1.0) + F.exp(-_margin(at)))
            summed = rows.select(
                "*", delayed.alias("p"), *[_feature(x).alias(f"x{i}") for i, x in enumerate(names)]
            )
            slopes = [
                F.sum(F.col("weight") * (F.col(LABEL) - F.col("p")) * F.col(f"x{i}"))
                for i in range(len(names))
            ]
            curves = [
                F.sum(F.col("weight") * F.col("p") * (1 - F.col("p")) * F.col(f"x{i}") * F.col(f"x{j}"))
                for i in range(len(names))
                for j in range(len(names))
            ]
            found = summed.agg(*slopes, *curves).first()
            if found[0] is None:
                break  # no orders
            slope, curve = np.array(found[: len(names)]), np.array(found[len(names) :])
            step = np.linalg.lstsq(curve.reshape(len(names), -1), slope, rcond=None)[0]
            weights = weights + step
            if np.abs(step).max() < NEWTON_STEP:
                break
    finally:
        rows.unpersist()
    return Linear(float(weights[0]), tuple(map(float, weights[1:])))


def _feature(name: str | None) -> Column:
    return (F.lit(1.0) if name is None else F.col(name)).cast("double")


def _margin(model: LogisticRegressionModel | Linear) -> Column:
    """The model's linear score as a column, so that rows stay in generated code."""
    margin = F.lit(float(model.intercept))
    for name, weight in zip(FEATURES, model.coefficients, strict=True):
        margin = margin + F.lit(float(weight)) * F.col(name)
    return margin


def predict(model: LogisticRegressionModel | Linear, features: DataFrame) -> DataFrame:
    """Prediction and class probabilities per order; a map over the rows, no shuffle."""
    delayed = F.lit(1.0) / (F.lit(1.0) + F.exp(-_margin(model)))
    return features.withColumn("delayed", delayed).select(
        "order_id",
        "customer_id",
        LABEL,
        (F.col("delayed") > model.getThreshold()).cast("double").alias("predicted_delay"),
        F.array(F.lit(1.0) - F.col("delayed"), F.col("delayed")).alias("probability"),
    )


def area_under_roc(model: LogisticRegressionModel | Linear, features: DataFrame) -> float:
    """Area under the ROC curve; orders with equal features share one weighted point."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="margin", labelCol=LABEL, weightCol="weight", numBins=0
    )
    return evaluator.evaluate(_weighted(features).withColumn("margin", _margin(model)))
