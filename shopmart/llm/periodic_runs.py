"""Periodic runs of words: passages that repeat a few words over and over.

A run is a stretch of words with smallest period q (words q apart are equal) of at least
``MIN_LENGTH`` words and ``POWER`` times q which no neighbouring word extends.

Documents are exploded into overlapping tiles, by octaves of the period: tiles of the base level
serve all periods below ``2 * BASE``, those of each higher level the periods from P to 2P - 1, and
only in documents long enough to hold such a run. Tiles of a level overlap by 4 periods or more, so each
part of a run that its tiles see has full length and meets its neighbours' in a whole period.
Tiles are dealt out over all tasks, so that a long document is many tasks' work, and solved
independently. A boundary stands every P words. Its Z-function (how many words from the
boundary on agree with those d further) is asked for the smallest d with 2P words or more, for
all boundaries at once by hashes of doubled width, each hit compared word by word. If that d is
below P, the words there have a shorter period; if it is in the octave, it is the only period there, and
fragments are as long as words d apart agree. Fragments are shuffled by document and
period, and those that share a period's length of words are stitched.

Words are ``[^\\x20\\x09-\\x0D]+``. Nulls: a null text has no words, a null id is kept. Repeated rows each get their
row. Empty texts have no run; empty tables give no rows. Only the two named columns are
read, so other columns cannot clash. A row's words and its runs are held by one task, and a tile
is at most the document; nothing grows with the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopmart.llm.common import bitmap, bitmap_place, in_bitmap, stored, tidy
from shopmart.llm.tokens import text_slices

MIN_LENGTH = 6
POWER = 4
BASE = 512  # periods below twice this share the base tiles
TILE = 40  # words of a tile, as a multiple of the level's P
OVERLAP = 8  # of it shared with the next tile: POWER times the largest period
BATCH_WORDS = 250_000
CELLS = 1 << 22
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"

_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes each."""
    x = a * _MIX[0] + (b ^ (b >> np.uint64(29))) * _MIX[1]
    return x ^ (x >> np.uint64(32))


def _smallest_shift(w: np.ndarray, at: int, width: int) -> int:
    """The smallest d below ``width`` whose Z-value is ``width`` or more, word by word; 0 if there is none."""
    own = w[at : at + width]
    return next((d for d in range(1, width) if np.array_equal(own, w[at + d : at + d + width])), 0)


def _shifts(w: np.ndarray, hashes: np.ndarray, p: int) -> np.ndarray:
    """Of each boundary (every ``p`` words), the smallest d below 2p for which 2p words from there
    on agree with those d further; 0 if there is none. ``hashes`` are those of 2p words."""
    width = 2 * p
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    windows = np.lib.stride_tricks.sliding_window_view(padded[1:], width - 1)[::p]
    own = hashes[::p]
    windows = windows[: len(own)]
    out = np.zeros(len(own), np.int64)
    step = max(1, CELLS // width)
    for a in range(0, len(own), step):
        equal = windows[a : a + step] == own[a : a + step, None]
        hit = np.flatnonzero(equal.any(axis=1))
        d = equal[hit].argmax(axis=1) + 1
        places = (hit + a) * p
        # A hash may deceive; words decide. Windows that pass the end are of the padding.
        inside = places + d + width <= len(w)
        hit, d, places = hit[inside], d[inside], places[inside]
        index = places[:, None] + np.arange(width)
        true = (w[index] == w[index + d[:, None]]).all(axis=1)
        for k in np.flatnonzero(~true):
            d[k] = _smallest_shift(w, int(places[k]), width)
        out[hit + a] = d
    return out


def _fragments(tile: np.ndarray, q: int, least: int) -> Iterator[tuple[int, int]]:
    """From, to: stretches of at least ``least`` words of a tile in which words q apart agree."""
    equal = np.concatenate([[False], tile[:-q] == tile[q:], [False]])
    edges = np.flatnonzero(equal[1:] != equal[:-1])
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        if b - a + q >= least:
            yield a, b + q


def solve(
    tiles: list[np.ndarray], octaves: list[int], least: int = MIN_LENGTH
) -> Iterator[tuple[int, int, int, int]]:
    """Tile, from, to, period: the runs' parts in tiles of word numbers, for periods of some octaves,
    from ``least`` words and ``POWER`` periods on.

    ``octaves`` are powers of two in ascending order, each for the periods from it to its double. Tiles are put one after
    another, the longest first, with a number of its own between two, so that nothing
    crosses a tile's end and an octave looks at those alone that can hold its runs.
    """
    order = sorted(range(len(tiles)), key=lambda k: -len(tiles[k]))
    parts: list[np.ndarray] = []
    for n, k in enumerate(order):
        parts += [tiles[k].astype(np.int64), np.array([-1 - n])]
    w = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    sizes = np.array([len(tiles[k]) for k in order], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    hashes, width = _joined(w.astype(np.uint64), w.astype(np.uint64)), 1
    for p in octaves:
        used = int(np.count_nonzero(sizes >= POWER * p))
        if not used:
            return
        n = int(begins[used - 1] + sizes[used - 1]) + 1
        hashes = hashes[: max(0, n - width + 1)]
        while width < 2 * p:
            hashes = _joined(hashes[: len(hashes) - width], hashes[width:])
            width *= 2
        shift = _shifts(w[:n], hashes, p)
        found = np.flatnonzero(shift >= p)
        owner = np.searchsorted(begins, found * p, "right") - 1
        for t, q in sorted({*zip(owner.tolist(), shift[found].tolist(), strict=True)}):
            begin = int(begins[t])
            tile = w[begin : begin + int(sizes[t])]
            for a, b in _fragments(tile, q, max(least, POWER * q)):
                # The first boundary in the fragment knows whether a shorter period holds there.
                if shift[-(-(begin + a) // p)] == q:
                    yield order[t], a, b, q


def _levels(n: int) -> Iterator[int]:
    """The P of each level above the base that a document of n words has tiles of."""
    p = 2 * BASE
    while POWER * p <= n:
        yield p
        p *= 2


def _tiles(words: list[bytes]) -> Iterator[tuple[int, int, np.ndarray]]:
    """P of the level, first word, word numbers: overlapping tiles that cover a document."""
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(x, len(numbers)) for x in words), np.int64, len(words))
    ids = ids.astype(np.min_scalar_type(max(len(numbers) - 1, 0)))
    for p in (BASE, *_levels(len(words))):
        start = 0
        while True:
            yield p, start, ids[start : start + TILE * p]
            if start + TILE * p >= len(words):
                break
            start += (TILE - OVERLAP) * p


def _bytes(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def fragments(keyed: DataFrame, least: int = MIN_LENGTH) -> DataFrame:
    """``key``, ``period``, ``start``, ``stop``: parts of runs, as the tiles of each text have them."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch.column("text")):
                part = batch.slice(a, b - a)
                keys, rows = part.column("key").to_pylist(), []
                for key, text in zip(keys, _bytes(part.column("text")), strict=True):
                    words = text.split()
                    if len(words) >= least:
                        rows += [(key, p, s, len(t), t.tobytes()) for p, s, t in _tiles(words)]
                if rows:
                    columns = zip(*rows, strict=True)
                    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, ["key", "p", "first", "n", "ids"])

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, p, first, n, ids = (c.to_pylist() for c in batch.columns)
            out: list[tuple] = []
            for level in sorted(set(p)):
                octaves = [1 << k for k in range(BASE.bit_length())] if level == BASE else [level]
                group: list[int] = []
                held = 0
                own = [k for k in range(len(p)) if p[k] == level]
                for k in own:
                    group.append(k)
                    held += n[k]
                    if held >= BATCH_WORDS or k == own[-1]:
                        tiles = [np.frombuffer(ids[j], f"u{len(ids[j]) // n[j]}") for j in group]
                        for t, a, b, q in solve(tiles, octaves, least):
                            j = group[t]
                            out.append((key[j], q, first[j] + a, first[j] + b))
                        group, held = [], 0
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "period", "start", "stop"])

    tiles = keyed.select("key", "text").mapInArrow(
        tidy(explode), "key binary, p long, first long, n long, ids binary"
    )
    dealt = tiles.repartition("key", "p", "first")
    return dealt.mapInArrow(tidy(solved), "key binary, period long, start long, stop long")


def stitched(parts: DataFrame) -> DataFrame:
    """Runs (``key``, ``start``, ``length``, ``period``) from their parts, which repeat and overlap."""
    parts = parts.distinct()
    ordered = Window.partitionBy("key", "period").orderBy("start", "stop")
    reach = F.max("stop").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("start") > reach - F.col("period"), F.lit(True))
    run = F.sum(F.col("begins").cast("long")).over(ordered)
    numbered = parts.withColumn("begins", begins).withColumn("run", run)
    whole = numbered.groupBy("key", "period", "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop")
    )
    return whole.select("key", "start", (F.col("stop") - F.col("start")).alias("length"), "period")


def _collapsed(text: bytes, runs: list[dict]) -> bytes:
    """The words, joined by single spaces, that no run contains after its first period."""
    words = text.split()
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, [r["start"] + r["period"] for r in runs], 1)
        np.add.at(change, [r["start"] + r["length"] for r in runs], -1)
        words = [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return b" ".join(words)


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    power: int = POWER,
) -> DataFrame:
    """Every row's id, ``runs`` (by start, then period; word numbers from 0) and ``collapsed``: the text's
    words without those that repeat a period before them.

    Texts with runs are joined to them by a digest of id and text. Texts that surely have none are told
    by a bitmap of bounded size, so they are not shuffled. ``power`` is 4 or more, as tiles assume.
    """
    if power < POWER or min_length < 1:
        raise ValueError(f"power must be at least {POWER} and min_length at least 1")
    name = F.col("id").cast("string")
    named = F.coalesce(F.concat(F.octet_length(name).cast("string"), F.lit(":"), name), F.lit("-"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    keyed = keyed.withColumn("key", F.unhex(F.md5(F.concat(named, F.col("text")).cast("binary"))))
    found = stitched(fragments(keyed, min(min_length, BASE)))
    found = found.where(F.col("length") >= F.greatest(F.lit(min_length), power * F.col("period")))
    found = found.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs")
    )
    found = stored(found, "runs")
    known = bitmap(found, "key")
    kind = keyed.schema["id"].dataType.simpleString()

    def split(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                some = in_bitmap(known, batch.column("place").to_numpy()) == wanted
                yield batch.filter(pa.array(some)).select(["id", "text", "key"])

        return run

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch.column("text")):
                part = batch.slice(a, b - a)
                runs = part.column("runs").to_pylist()
                texts = _bytes(part.column("text"))
                done = [_collapsed(t, r or []) for t, r in zip(texts, runs, strict=True)]
                column = pa.array(done, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("runs"), column], [id_col, "runs", "collapsed"]
                )

    placed = keyed.withColumn("place", bitmap_place("key"))
    columns = f"id {kind}, text string, key binary"
    some = placed.mapInArrow(split(True), columns).join(found, "key", "left")
    none = placed.mapInArrow(split(False), columns).withColumn("runs", F.lit(None).cast(RUNS))
    both = some.select("id", "text", "runs").unionByName(none.select("id", "text", "runs"))
    both = both.withColumn("runs", F.coalesce("runs", F.array().cast(RUNS)))
    return both.mapInArrow(tidy(collapse), f"`{id_col}` {kind}, runs {RUNS}, collapsed string")


def strongest(runs):
    """Of an array of runs, that with the greatest exact length by period; of ties the first."""

    def better(best, run):
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, better)
