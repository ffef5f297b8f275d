"""Filters of addresses by lists that change over time.

A list entry is dated: from then on a domain (with all below it) or a page is on a list,
or no longer. Entries become validity intervals: from an entry that lists a key to the next one for the same
list and key. An as-of join finds, for every capture, the last interval of each list and key that began by
the time of its fetch, and the capture is on the list if that interval has not ended.

The join sorts intervals and captures together by key, list and time and deals them out in ranges of even size, so
the rows of one key, of one day too, are spread over as many tasks as they need. Within a range the last interval is
carried forward; what was last before a range comes from a table with one row per key, list and range.

A column ``lists`` or ``is_blocked`` of the captures gives way to the result's; all others are kept. Nulls: a capture without address or time is on no list; an entry with a null in any column says
nothing. Changes of the same moment: a removal wins. Repeated changes count once, repeated captures
each get a row. Empty lists leave all captures unlisted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopmart.llm.common import lookup, stored

def host(url: Column) -> Column:
    """The host of an address in lower case, without user, port or final dot; '' if there is none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.regexp_replace(found, r"\.$", "")


def page_key(url: Column) -> Column:
    """Host and path, without query, fragment and slashes at the end; '' if there is no host."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    key = F.concat(host(url), F.regexp_replace(path, "/+$", ""))
    return F.when(host(url) != "", key).otherwise("")


def parents(name: Column) -> Column:
    """A host and the domains above it, down to two labels."""
    labels = F.split(name, r"\.")
    n = F.size(labels)
    starts = F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)))
    return F.transform(starts, lambda k: F.array_join(F.slice(labels, k, n), "."))


def keys(url: Column) -> Column:
    """All keys under which an address may be listed, each once."""
    of_page = F.when(page_key(url) != "", F.array(F.concat(F.lit("page:"), page_key(url))))
    of_host = F.when(
        host(url) != "", F.transform(parents(host(url)), lambda x: F.concat(F.lit("domain:"), x))
    )
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(of_host, none), F.coalesce(of_page, none)))


def intervals(entries: DataFrame) -> DataFrame:
    """Entries (list, key, at, is_listed) as validity intervals: list, key, valid_from, valid_to.

    ``valid_to`` is null where an entry still holds. Touching intervals stay apart. The entries of one key
    are ordered over as many ranges as they fill; the first of each range ends the last of the one before.
    """
    dealt = _changes(entries).repartitionByRange("key", "list", "at")
    dealt = stored(dealt.select("*", F.spark_partition_id().alias("range")), "list-changes")
    after = F.lead("at").over(Window.partitionBy("range", "key", "list").orderBy("at"))
    heads = dealt.groupBy("key", "list", "range").agg(F.min("at").alias("head"))
    later = F.lead("head").over(Window.partitionBy("key", "list").orderBy("range"))
    found = dealt.withColumn("after", after).join(heads.withColumn("later", later), ["key", "list", "range"])
    valid_to = F.coalesce("after", "later").alias("valid_to")
    return found.where("is_listed").select("list", "key", F.col("at").alias("valid_from"), valid_to)


def _changes(entries: DataFrame) -> DataFrame:
    clean = entries.select("list", "key", "at", "is_listed").dropna()
    return clean.groupBy("list", "key", "at").agg(F.min("is_listed").alias("is_listed"))


def listed(captures: DataFrame, entries: DataFrame, id_col: str, url_col: str, time_col: str) -> DataFrame:
    """``id`` and ``list``, distinct: the lists that a capture was on when it was fetched."""
    valid = stored(intervals(entries), "list-intervals")
    asked = captures.select(
        F.col(id_col).alias("id"),
        F.explode(keys(F.col(url_col))).alias("key"),
        F.col(time_col).cast("timestamp").alias("at"),
    ).where(F.col("at").isNotNull())
    # One row per key: the lists that know it at all. A key of very many captures is broadcast.
    known = valid.groupBy("key").agg(F.collect_set("list").alias("known"))
    counts = asked.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    known = stored(known.join(counts, "key"), "listed-keys")
    found = lookup(asked, known, "key", "n")
    asked = found.select("id", "key", "at", F.explode("known").alias("list"))

    interval = F.struct(F.col("valid_from").alias("since"), F.col("valid_to").alias("until"))
    begun = valid.select(
        F.lit(None).cast(asked.schema["id"].dataType).alias("id"),
        "key",
        F.col("valid_from").alias("at"),
        "list",
        interval.alias("interval"),
        F.lit(False).alias("is_capture"),
    )
    empty = F.lit(None).cast("struct<since:timestamp,until:timestamp>")
    rows = begun.unionByName(asked.withColumns({"interval": empty, "is_capture": F.lit(True)}))
    dealt = rows.repartitionByRange("key", "list", "at", "is_capture", F.xxhash64("id"))
    # Written, so that all uses below see the same ranges.
    dealt = stored(dealt.select("*", F.spark_partition_id().alias("range")), "list-ranges")

    # Within a range: the last interval that began by the fetch.
    so_far = (
        Window.partitionBy("range", "key", "list")
        .orderBy("at", "is_capture")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    last = F.last("interval", ignorenulls=True).over(so_far)
    within = dealt.withColumn("last", last).where("is_capture")

    # Before a range: the last interval of the latest earlier range with any.
    ends = dealt.groupBy("key", "list", "range").agg(F.max("interval").alias("end"))
    before = Window.partitionBy("key", "list").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("key", "list", "range", F.last("end", ignorenulls=True).over(before).alias("carried"))

    found = within.join(carried, ["key", "list", "range"])
    until = F.coalesce("last", "carried")
    holds = until.isNotNull() & (until["until"].isNull() | (until["until"] > F.col("at")))
    return found.where(holds).select("id", "list").distinct()


def filter_captures(
    captures: DataFrame,
    entries: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    time_col: str = "fetched_at",
) -> DataFrame:
    """Every capture with ``lists`` (those it was on when fetched, sorted) and ``is_blocked``.

    Captures that share an id, or have none, are evaluated together, as if they were one.
    """
    found = listed(captures, entries, id_col, url_col, time_col)
    per_id = found.groupBy(F.struct("id").alias("key")).agg(F.sort_array(F.collect_set("list")).alias("found"))
    kept = [c for c in captures.columns if c not in ("lists", "is_blocked")]
    own = captures.select(
        F.struct(F.col(id_col).alias("id")).alias("key"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("own")
    )
    lists = F.coalesce("found", F.array().cast("array<string>"))
    whole = own.join(per_id, "key", "left").withColumn("lists", lists)
    return whole.select("own.*", "lists", (F.size("lists") > 0).alias("is_blocked"))
