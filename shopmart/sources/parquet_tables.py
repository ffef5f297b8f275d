"""Parquet source: one dataset per table under a base path."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def read_tables(spark: SparkSession, base: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Lazy scans; what a plan does not use of them is not read."""
    return {name: spark.read.parquet(f"{base.rstrip('/')}/{name}") for name in names}
