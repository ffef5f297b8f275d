"""Column expressions shared by the plans. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(timestamp: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(timestamp.cast("date"), "month")


def days_between(end: Column, start: Column) -> Column:
    """Whole calendar days; negative when ``end`` is earlier, NULL if either is NULL."""
    return F.datediff(end, start)


def mean(total: Column, count: Column) -> Column:
    """Mean from a sum and a count; NULL for a group without values."""
    return F.try_divide(total.cast("double"), count)


def order_item_key(order_id: Column, order_item_id: Column) -> Column:
    """Readable line key; NULL if either part is NULL."""
    return F.concat(order_id.cast("string"), F.lit("_"), order_item_id.cast("string"))


def item_revenue(price: Column, freight: Column) -> Column:
    """Price plus freight; NULL if either is NULL."""
    return price + freight


def delayed_flag(delivered: Column, estimated: Column) -> Column:
    """1 if the order came after the estimate, else 0, also when a date is missing."""
    return F.when(delivered > estimated, 1).otherwise(0)
