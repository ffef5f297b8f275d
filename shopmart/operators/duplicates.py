"""Whole-row duplicate counts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_profile(name: str, df: DataFrame) -> DataFrame:
    """One row: total, distinct and duplicate rows of a table.

    Rows are grouped by a digest of 128 bits first, so that of most rows 16 bytes cross the
    shuffle. Only rows whose digest repeats are compared whole, copies having been collapsed into a
    count before the shuffle; the figures are exact even where digests deceive.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    digest = [F.xxhash64(F.lit(seed), *columns).alias(f"__d{seed}") for seed in (1, 2)]
    keys = ["__d1", "__d2"]
    rows = df.select(*digest, F.struct(*columns).alias("__row"))
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    repeated = counts.where(F.col("__n") > 1).select(*keys)
    copies = rows.join(repeated, keys, "left_semi").groupBy(*keys, "__row")
    copies = copies.agg(F.count(F.lit(1)).alias("__copies"))
    nothing = F.lit(0).cast("long")
    figures = counts.agg(F.count_if(F.col("__n") == 1).alias("one")).select(
        "one", nothing.alias("distinct"), nothing.alias("all")
    )
    several = copies.agg(
        F.count(F.lit(1)).alias("distinct"), F.coalesce(F.sum("__copies"), F.lit(0)).alias("all")
    )
    figures = figures.unionByName(several.withColumn("one", nothing))
    sums = figures.agg(*[F.sum(c).alias(c) for c in ("one", "distinct", "all")])
    return sums.select(
        F.lit(name).alias("table_name"),
        (F.col("one") + F.col("all")).alias("total_rows"),
        (F.col("one") + F.col("distinct")).alias("distinct_rows"),
        (F.col("all") - F.col("distinct")).alias("duplicate_rows"),
    )


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``duplicate_profile`` of every table, as one plan."""
    return reduce(DataFrame.unionByName, [duplicate_profile(n, df) for n, df in tables.items()])


def count_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table, as one plan."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
        for n, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
