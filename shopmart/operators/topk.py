"""Ranked cuts with a total order, so that the cut is the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def largest(df: DataFrame, metric: str, keys: list[str], limit: int | None) -> DataFrame:
    """The ``limit`` groups with the largest metric; equal metrics rank by key, NULL key last.

    Without a limit all groups, in no order.
    """
    if limit is None:
        return df
    ties = [F.asc_nulls_last(key) for key in keys]
    return df.orderBy(F.desc_nulls_last(metric), *ties).limit(limit)


def earliest(df: DataFrame, keys: list[str], limit: int | None) -> DataFrame:
    """The first ``limit`` groups in key order; without a limit all, in no order."""
    if limit is None:
        return df
    return df.orderBy(*[F.asc_nulls_last(key) for key in keys]).limit(limit)
