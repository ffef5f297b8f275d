"""One-permutation MinHash fingerprints with DataFrame functions only.

Every word shingle is hashed once. The hash's high bits choose one of ``BINS``
bins, the rest is its value, and a bin keeps its smallest value. An empty bin
takes the value of a filled one, which it finds by its own sequence of hashed probes
(optimal densification): all texts probe in the same order, so equal sets fill
their bins alike. After ``PROBES`` misses it takes the filled bin with the smallest
hash of both numbers, again the same for all texts. A fingerprint packs
four bits of every bin, hashed with the number of the bin. By chance, one bin in 16
agrees between unlike texts; ``likeness`` takes that share out.

Words are separated by Spark's ``\\s``. A text of fewer words than a shingle is one shingle,
a text without words (null, empty, white space) has the fingerprint of zeros;
it is like another such text (1) and unlike all others (0).
All of it is an expression on one row: no shuffle, and memory for one text.
"""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopmart.llm.common import stored

WORDS = 5
BINS = 256
PROBES = 16
PER_LONG = 16  # bins of 4 bits in a 64-bit number
_VALUE_BITS = 55  # a hash without its sign is 8 bits of bin and 55 of value
_EMPTY = (1 << _VALUE_BITS) - 1


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shingle_hashes(text: Column) -> Column:
    def hashes(words: Column) -> Column:
        last = F.size(words) - WORDS

        def at(i: Column) -> Column:
            shingle = F.xxhash64(*[F.get(words, i + k) for k in range(WORDS)])
            return F.shiftrightunsigned(shingle, 1)

        several = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), at)
        return F.when(F.size(words) > 0, several).otherwise(F.array().cast("array<bigint>"))

    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")
    return bound(words, hashes)


def _minima(hashes: Column) -> Column:
    """The smallest value of each bin, or null, as an array of ``BINS`` numbers."""
    # One key per bin that no hash lies above, so that every bin occurs.
    ends = F.array(*[F.lit(b << _VALUE_BITS | _EMPTY) for b in range(BINS)])

    def firsts(ordered: Column) -> Column:
        def begins_bin(key: Column, i: Column) -> Column:
            apart = key.bitwiseXOR(F.get(ordered, i - 1)) > F.lit(_EMPTY)
            return F.coalesce(apart, F.lit(True))

        return F.transform(
            F.filter(ordered, begins_bin),
            lambda key: F.nullif(key.bitwiseAND(F.lit(_EMPTY)), F.lit(_EMPTY)),
        )

    return bound(F.sort_array(F.concat(hashes, ends)), firsts)


def _probes(attempt: int) -> Column:
    """The bin that each empty bin looks at in an attempt: random numbers, the same everywhere."""
    rng = random.Random(attempt)
    return F.array(*[F.lit(rng.randrange(BINS)) for _ in range(BINS)])


def _densified(minima: Column) -> Column:
    def nearest(b: Column) -> Column:
        filled = F.filter(
            F.transform(
                minima, lambda v, j: F.when(v.isNotNull(), F.struct(F.xxhash64(b, j), v.alias("v")))
            ),
            lambda s: s.isNotNull(),
        )
        return F.array_min(filled)["v"]

    def filled(value: Column, b: Column) -> Column:
        probed = [F.get(minima, F.get(_probes(k), b)) for k in range(PROBES)]
        return F.coalesce(value, *probed, nearest(b))

    return F.transform(minima, filled)


def _packed(values: Column) -> Column:
    def number(word: Column) -> Column:
        def step(acc: Column, k: Column) -> Column:
            b = word * PER_LONG + k
            low = F.xxhash64(F.get(values, b), b).bitwiseAND(F.lit(15))
            return F.shiftleft(acc, 4).bitwiseOR(low)

        return F.aggregate(F.sequence(F.lit(0), F.lit(PER_LONG - 1)), F.lit(0).cast("bigint"), step)

    return F.transform(F.sequence(F.lit(0), F.lit(BINS // PER_LONG - 1)), number)


def minhash(text: Column) -> Column:
    """The packed fingerprint of a text: an array of 16 numbers of 64 bits."""
    zeros = F.array_repeat(F.lit(0).cast("bigint"), BINS // PER_LONG)

    def of_hashes(hashes: Column) -> Column:
        dense = bound(_minima(hashes), lambda m: bound(_densified(m), _packed))
        return F.when(F.size(hashes) > 0, dense).otherwise(zeros)

    return bound(_shingle_hashes(text), of_hashes)


def fingerprint_text(fingerprint: Column) -> Column:
    """256 hexadecimal digits, one per bin."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingles of two fingerprinted texts, 0 to 1."""
    ones = 0x1111111111111111

    def differing(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        return F.bit_count(d.bitwiseAND(F.lit(ones)))

    apart = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, d: s + d)
    agree = 1 - apart / F.lit(float(BINS))
    chance = 1 / 16
    estimate = F.greatest(F.lit(0.0), (agree - chance) / (1 - chance))
    none = F.forall(a, lambda x: x == 0) | F.forall(b, lambda x: x == 0)
    return F.when(apart == 0, 1.0).when(none, 0.0).otherwise(estimate)


def next_ids(ids: DataFrame, id_col: str, next_col: str) -> DataFrame:
    """Distinct ids and the next larger one of each; after the largest, the smallest.

    Ids are dealt out by range, each range finds its own successors, and the
    last of a range takes the first of the next from a table with one row per
    range.
    """
    ranged = ids.select(id_col).distinct().repartitionByRange(F.col(id_col).asc_nulls_first())
    # Written, so that both uses below see the same ranges.
    placed = stored(ranged.select(id_col, F.spark_partition_id().alias("_range")), "id-ranges")
    inside = Window.partitionBy("_range").orderBy(F.col(id_col).asc_nulls_first())
    found = placed.select(
        id_col,
        "_range",
        F.lead(F.struct(id_col)).over(inside).alias("_next"),
    )
    heads = placed.groupBy("_range").agg(F.min(F.struct(id_col)).alias("_head"))
    order = Window.partitionBy(F.lit(0)).orderBy("_range")
    everywhere = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One row per range: few, whatever the number of ids.
    after = heads.select(
        "_range",
        F.coalesce(F.lead("_head").over(order), F.first("_head").over(everywhere)).alias("_after"),
    )
    return (
        found.join(after, "_range")
        .select(id_col, F.coalesce("_next", "_after")[id_col].alias(next_col))
    )


def edited(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every text beside its edited form: the last quarter of its code points
    gives way to the first as many of the next document's (or all it has).

    Columns: the id, ``text``, ``fingerprint``, ``n_chars``, ``edited``, ``next_fingerprint``. The next
    document is that with the next larger id, after the largest the smallest
    (a null id is the smallest). Where an id has several rows, each gets a row here,
    and the next document's text is the smallest of its texts. Whole texts are
    shuffled once, by id; a text sends its neighbour only what that asks for.
    """
    own = docs.select(
        F.struct(F.col(id_col)).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    links = next_ids(docs, id_col, "next_id").select(
        F.struct(F.col(id_col)).alias("key"), F.struct(F.col("next_id").alias(id_col)).alias("next_key")
    )
    quarter = F.floor(F.char_length("text") / 4).cast("int")
    asked = own.groupBy(F.xxhash64("key").alias("slot"), "key").agg(F.max(quarter).alias("most"))
    asked = asked.join(links, "key").select(
        F.col("key").alias("asking"), "most", F.xxhash64("next_key").alias("slot"), "next_key"
    )
    # A hash of the key is what both joins meet on, so that one shuffle of the texts serves both.
    marked = own.select(
        F.xxhash64("key").alias("slot"), "key", "text", minhash(F.col("text")).alias("fingerprint")
    )
    is_next = F.col("d.key").eqNullSafe(F.col("a.next_key"))
    found = marked.alias("d").join(
        asked.alias("a"), (F.col("d.slot") == F.col("a.slot")) & is_next
    )
    heads = found.select(
        F.xxhash64("a.asking").alias("slot"),
        F.col("a.asking").alias("key"),
        F.struct(
            F.expr("substring(d.text, 1, a.most)").alias("head"),
            F.col("d.fingerprint").alias("next_fingerprint"),
        ).alias("after"),
    )
    heads = heads.groupBy("slot", "key").agg(F.min("after").alias("after"))
    is_own = F.col("d.key").eqNullSafe(F.col("h.key"))
    joined = marked.alias("d").join(
        heads.alias("h"), (F.col("d.slot") == F.col("h.slot")) & is_own
    )
    n, k = F.char_length("d.text"), F.floor(F.char_length("d.text") / 4).cast("int")
    return joined.select(
        F.col(f"d.key.{id_col}").alias(id_col),
        F.col("d.text").alias("text"),
        n.cast("long").alias("n_chars"),
        F.col("d.fingerprint").alias("fingerprint"),
        F.concat(
            F.substr("d.text", F.lit(1), n - k), F.substr("h.after.head", F.lit(1), k)
        ).alias("edited"),
        F.col("h.after.next_fingerprint").alias("next_fingerprint"),
    )
