"""How far a join multiplies rows, and a join whose heavy keys are dealt out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fanout(
    name: str, left: DataFrame, left_key: str, right: DataFrame, right_key: str
) -> DataFrame:
    """How far a left join on the keys would multiply rows, without running it.

    One row: rows of the left side, keys that repeat on the right and the most
    rows one of them has, rows of the join as it stands, and rows of the join
    to a right side grouped to one row per key. Both sides are counted per key
    in one grouping, so no pair of rows is ever formed.
    """
    here, there = F.lit(1).cast("long"), F.lit(0).cast("long")
    keys = left.select(F.col(left_key).alias("k"), here.alias("l"), there.alias("r")).unionByName(
        right.select(F.col(right_key).alias("k"), there.alias("l"), here.alias("r"))
    )
    # A NULL key matches nothing.
    partners = F.when(F.col("k").isNotNull(), F.col("r")).otherwise(0)
    counts = keys.groupBy("k").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    joined = F.col("l").cast("decimal(19,0)") * F.greatest(partners, F.lit(1)).cast("decimal(19,0)")
    return counts.agg(
        F.sum("l").alias("left_rows"),
        F.count_if(partners > 1).alias("repeated_keys"),
        F.max(partners).alias("max_rows_per_key"),
        F.sum(joined).cast("double").alias("joined_rows"),
        F.sum("l").cast("double").alias("joined_rows_after_grouping"),
    ).select(F.lit(name).alias("join_name"), "*")


# A key with over a thousandth of the rows is heavy; by arithmetic there are fewer than a thousand.
HEAVY_SHARE = 1000


def heavy_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys with over 1/1000 of all rows, exactly, and their ``salts``: parts of 1/1000 each.

    Rows are counted per key on the map side first, so a heavy key costs no more than another.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col(key).isNotNull())
    total = rows.agg(F.count(F.lit(1))).scalar()
    heavy = counts.where(F.col("n") * HEAVY_SHARE > total)
    return heavy.select(key, F.ceil(F.col("n") * HEAVY_SHARE / total).cast("int").alias("salts"))


SALT, _SALTS = "__salt", "__salts"


def deal(many: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ``many`` with a salt, and the heavy keys that ``meet`` needs.

    Rows of a heavy key are dealt out over its salts by their place in ``many``, so equal rows are too; all others have
    salt 0. ``many`` is a scan of files, whose rows have the same places when a task is repeated; joins may follow before
    the rows meet the other side.
    """
    heavy = F.broadcast(heavy_keys(many, key).withColumnRenamed("salts", _SALTS))
    place = F.xxhash64(F.monotonically_increasing_id())
    chosen = F.pmod(place, F.coalesce(F.col(_SALTS), F.lit(1))).cast("int").alias(SALT)
    return many.join(heavy, key, "left").select(*many.columns, chosen), heavy


def meet(dealt: DataFrame, one: DataFrame, key: str, heavy: DataFrame, how: str = "inner") -> DataFrame:
    """Join of dealt rows to ``one``, whose rows with a heavy key are repeated for each salt.

    The rows keep their salt: another ``meet`` on the key finds them where they are and moves only its ``one``.
    """
    each = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)).alias(SALT)
    return dealt.join(one.join(heavy, key, "left").select(*one.columns, each), [key, SALT], how)


def spread_join(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """Inner join of ``many`` to ``one`` on a key that any number of rows of ``many`` may share.

    Rows of a heavy key are dealt out (``deal``), and the rows of ``one`` with such a key are repeated for each
    salt (``meet``): fewer than 2,000 more rows per repetition of a key in ``one``. The heavy keys, fewer than 1,000
    by arithmetic, are broadcast. All is one plan, in which
    no task gets much more than a thousandth of the rows for one key; there is no switch by size.
    """
    dealt, heavy = deal(many, key)
    return meet(dealt, one, key, heavy).drop(SALT)
