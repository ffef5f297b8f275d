"""Parquet sink: full refresh of one dataset, with the row count of the same pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ROWS = "__rows"


def write_table(
    df: DataFrame, path: str, coalesce: int | None = None, rebalance: bool = False
) -> int:
    """Overwrite ``path`` and return the number of rows written.

    ``coalesce`` merges the output into at most that many files; it also
    limits the tasks of the last stage, so it is for small tables. With
    ``rebalance`` rows are shuffled into files of even, advisory size, which
    also spreads out an input that arrives in few tasks.
    """
    return write_measured(df, path, {}, coalesce, rebalance)[ROWS]


def write_measured(
    df: DataFrame,
    path: str,
    metrics: Mapping[str, Column],
    coalesce: int | None = None,
    rebalance: bool = False,
) -> dict[str, int]:
    """``write_table`` with further aggregates of the rows, taken in the pass that writes them.

    The result has the metrics by name, and the number of rows as ``ROWS``.
    """
    if coalesce and rebalance:
        raise ValueError("choose coalesce or rebalance")
    if coalesce:
        df = df.coalesce(coalesce)
    elif rebalance:
        df = df.hint("rebalance")
    # Taken after the last shuffle, where each row passes in exactly one
    # successful task.
    taken = Observation()
    named = [value.alias(name) for name, value in metrics.items()]
    observed = df.observe(taken, F.count(F.lit(1)).alias(ROWS), *named)
    observed.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return taken.get


def write_bucketed(
    df: DataFrame, path: str, metrics: Mapping[str, Column], key: str, buckets: int, scratch: str
) -> dict[str, int]:
    """``write_measured`` in one sorted file per bucket of ``key``.

    Spark writes buckets only by way of a table: ``scratch`` is registered for the length of the write. All
    rows of one key are in one bucket, so this is for keys of which none has a large share of the rows.
    """
    taken = Observation()
    named = [value.alias(name) for name, value in metrics.items()]
    dealt = df.repartition(buckets, key).observe(taken, F.count(F.lit(1)).alias(ROWS), *named)
    writer = dealt.write.mode("overwrite").format("parquet").option("compression", "snappy")
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {scratch}")
    writer.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(scratch)
    spark.sql(f"DROP TABLE {scratch}")  # the files of an external table stay
    return taken.get
