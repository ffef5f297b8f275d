"""SimHash fingerprints, linked by pivot distance tables.

A fingerprint's row of the table holds its Hamming distances to ``PIVOTS``
reference fingerprints, also apart for ranges of bits. If two fingerprints differ in at most
two bits, they agree in one of three ranges, and of the rest again in one of
three: their rows then agree in the distances over both ranges. So every fingerprint is dealt
out under nine keys made of such distances, and any link has a key in
common. Fingerprints with a key in common are compared: pairs whose distances to
some pivot differ by more than two are discarded (by the triangle inequality
they cannot be linked), and what is left is verified bit by bit. A large group
is cut further by the same rule, ranges within the bits that are left, until groups are
small or so few bits are left that all of the group is linked. No link is missed
and no partner is capped. Only one link per fingerprint leaves a group.

Nulls: a null text has no words; its fingerprint is zero, linked like any other. Empty tables give
empty results. Equal texts have equal fingerprints, and count once in all comparisons.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import lookup, stored, tidy
from shopmart.llm.components import components
from shopmart.llm.tokens import text_slices

WORDS = 3
SEED = 42
BITS = 2
PIVOTS = 16
SMALL = 512
# Bytes of the texts whose hashes a task holds at a time, 64 bytes each.
SLICE_CHARS = 500_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_RNG = np.random.default_rng(SEED)
_REFERENCES = _RNG.integers(0, 1 << 64, PIVOTS, np.uint64, endpoint=False)
_WEIGHTS = _RNG.integers(0, 1 << 64, (2, PIVOTS), np.uint64, endpoint=False) | np.uint64(1)


def shingle_hashes(text: str | None, n_words: int = WORDS) -> np.ndarray:
    """XXH64 of each shingle of ``n_words`` words, repeats included."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: max(0, len(words) - n_words)]]
    digest = xxhash.xxh64_intdigest
    stops = ends[min(n_words, len(words)) - 1 :]
    return np.array(
        [digest(joined[a : b - 1], SEED) for a, b in zip(starts, stops, strict=True)], np.uint64
    )


def fingerprint_all(texts: list[str | None]) -> np.ndarray:
    """Fingerprints of texts: a bit is 1 if it is 1 in over half of the hashes."""
    hashes = [shingle_hashes(t) for t in texts]
    counts = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(texts), np.uint64)
    used = np.flatnonzero(counts)
    if not len(used):
        return out
    joined = np.concatenate([hashes[k] for k in used])
    bits = np.unpackbits(joined.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    begins = np.cumsum(counts[used]) - counts[used]
    ones = np.add.reduceat(bits, begins, axis=0, dtype=np.int32)
    packed = np.packbits(2 * ones > counts[used][:, None], axis=1)
    out[used] = packed.view(">u8").ravel()
    return out


def text_digest(text_col: str) -> Column:
    """Tells texts apart where rows share an id; a null is an empty text."""
    return F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and ``fp`` (the fingerprint's 64 bits as a signed number) of every row."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch.column("text"), SLICE_CHARS):
                part = batch.slice(a, b - a)
                found = fingerprint_all(part.column("text").to_pylist()).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found)], [id_col, "fp"])

    return source.mapInArrow(tidy(run), f"`{id_col}` {kind}, fp long")


def _ranges(mask: int) -> list[int]:
    """The bits of a mask in three ranges."""
    places = [k for k in range(64) if mask >> k & 1]
    cuts = [len(places) * k // 3 for k in range(4)]
    return [sum(1 << k for k in places[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _distances(fps: np.ndarray, mask: int = (1 << 64) - 1) -> np.ndarray:
    """Hamming distances to the pivots, over the bits of a mask."""
    return np.bitwise_count((fps[:, None] ^ _REFERENCES) & np.uint64(mask))


def _key(fps: np.ndarray, mask: int, weights: np.ndarray) -> np.ndarray:
    return (_distances(fps, mask).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)


def _splits() -> list[tuple[int, int, int]]:
    """First range, second range and the bits outside of both, for each of the nine keys."""
    whole = (1 << 64) - 1
    return [(a, b, whole ^ a ^ b) for a in _ranges(whole) for b in _ranges(whole ^ a)]


SPLITS = _splits()


class _Roots:
    """Disjoint sets of the numbers below n."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def find(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = self.parent[self.parent[k]]
            k = self.parent[k]
        return int(k)

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def _compare(fps: np.ndarray, rows: np.ndarray, sets: _Roots) -> None:
    """Link rows of a small group."""
    table = _distances(fps[rows]).astype(np.int8)
    near = np.ones((len(rows), len(rows)), bool)
    for column in table.T:
        near &= np.abs(column[:, None] - column) <= BITS
    left, right = np.nonzero(np.triu(near, 1))
    linked = np.bitwise_count(fps[rows[left]] ^ fps[rows[right]]) <= BITS
    for a, b in zip(rows[left[linked]].tolist(), rows[right[linked]].tolist(), strict=True):
        sets.join(a, b)


def _runs(keys: np.ndarray) -> Iterator[np.ndarray]:
    """Places of equal keys, for keys that occur at least twice."""
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    for run in np.split(order, cuts):
        if len(run) > 1:
            yield run


def _link(fps: np.ndarray, rows: np.ndarray, free: int, sets: _Roots) -> None:
    """Link the rows of a group, which agree in all bits but those of ``free``."""
    if free.bit_count() <= BITS:
        for row in rows[1:].tolist():
            sets.join(int(rows[0]), row)
    elif len(rows) <= SMALL:
        _compare(fps, rows, sets)
    else:
        for part in _ranges(free):
            # Bits and not their distances, so that the group agrees in them for sure.
            for run in _runs(fps[rows] & np.uint64(part)):
                _link(fps, rows[run], free & ~part, sets)


def _group_links(fps: np.ndarray, split: int) -> Iterator[tuple[int, int]]:
    """Links of a group: every fingerprint to the least of those it is connected to here."""
    first, second, free = SPLITS[split]
    sets = _Roots(len(fps))
    # Keys are hashes of distances: rows may share one and yet differ in the ranges.
    for run in _runs(fps & np.uint64(first | second)):
        _link(fps, run, free, sets)
    for k in range(len(fps)):
        root = sets.find(k)
        if root != k:
            yield k, root


def links(fps: DataFrame) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp`` that connect what differs in two bits or fewer."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for k, (first, second, _) in enumerate(SPLITS):
                key = _key(values, first, _WEIGHTS[0]) + _key(values, second, _WEIGHTS[1])
                split = pa.array(np.full(len(values), k, np.int8))
                columns = [split, pa.array(key.view(np.int64)), pa.array(values.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["split", "key", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(split, fps, bounds) -> pa.RecordBatch:
            pairs = []
            for a, b in bounds:
                own = fps[a:b]
                pairs += [(own[u], own[v]) for u, v in _group_links(own.view(np.uint64), int(split[a]))]
            u, v = zip(*pairs, strict=True) if pairs else ((), ())
            columns = [pa.array(u, pa.int64()), pa.array(v, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["u", "v"])

        held = [np.zeros(0, np.int8), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        for batch in batches:
            new = [c.to_numpy() for c in batch.columns]
            split, key, fps = (np.concatenate(x) for x in zip(held, new, strict=True))
            cuts = np.flatnonzero((np.diff(key) != 0) | (np.diff(split) != 0)) + 1
            bounds = np.concatenate([[0], cuts])
            sizes = np.diff(bounds)
            several = [(int(bounds[k]), int(bounds[k + 1])) for k in np.flatnonzero(sizes > 1)]
            yield found(split, fps, several)
            last = int(bounds[-1])  # the last group may go on in the next batch
            held = [x[last:] for x in (split, key, fps)]
        if len(held[2]) > 1:
            yield found(held[0], held[2], [(0, len(held[2]))])

    dealt = fps.select("fp").mapInArrow(tidy(deal), "split byte, key long, fp long")
    grouped = dealt.repartition("split", "key").sortWithinPartitions("split", "key", "fp")
    return grouped.mapInArrow(tidy(compare), "u long, v long")


def _classes(found: DataFrame, key: Column) -> DataFrame:
    """Each distinct fingerprint ``fp`` with its rows ``n`` and ``first``, the smallest ``key`` of its component."""
    distinct = stored(
        found.groupBy("fp").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n")),
        "simhash-distinct",
    )
    roots = components(links(distinct))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first", "n", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return stored(rooted.drop("first").join(least, "root").select("fp", "n", "first"), "simhash-classes")


def near_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row's id, ``fp`` and ``component_id``: the smallest id that can be reached over links.

    Null ids take part, and are a component's id only where it has no other.
    """
    found = stored(fingerprints(docs, id_col, text_col), "simhash")
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"))
    classes = _classes(found, key)
    classes = classes.select("fp", "n", F.col("first.id").alias("component_id"))
    return lookup(found, classes, "fp", "n").select(id_col, "fp", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id, of several texts with this id that
    with the smallest digest, and of rows that repeat both any one.

    A null id is larger than all others. Only rows whose component keeps another row go, so the
    result has as many rows as there are components.
    """
    key = F.struct(
        F.col(id_col).isNull().alias("none"),
        F.col(id_col).alias("id"),
        text_digest(text_col).alias("digest"),
    ).alias("key")
    keyed = docs.select(key, F.col(text_col).cast("string").alias("text"))
    found = stored(fingerprints(keyed, "key"), "simhash-keys")
    kept = _classes(found, F.col("key")).select(F.col("first").alias("key")).distinct()
    rows = docs.select(key, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"))
    return rows.join(kept, "key", "left_semi").dropDuplicates(["key"]).select("own.*")
