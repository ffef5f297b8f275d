"""Harmonic packing of documents into token sequences.

Whole sequences are cut off a document first. Its rest of n ids belongs to the reciprocal-capacity class 1/k
with size / (k + 1) < n <= size / k, and stays whole: a bin of class 1/k takes k rests, whatever documents they are
from. What such a bin has left is filled by cutting as much off one more document, the filler, whose own rest
goes on to the next bins; so every sequence is full and has at most one document cut for it. Every task fills
bins of its own and nothing is shuffled. A task holds one open bin per class (fewer than twice
the square root of the size), one closed bin that waits for a filler, and the filler.

At its end a task puts what open bins hold one after another, largest first, and cuts it into whole sequences; the rest,
shorter than a sequence, is cut into powers of two, which need no padding. So no token of padding is added at all.

Nulls: a null text is an empty document (its end id alone), a null id is kept.
Repeated rows are documents of their own. An empty table gives no pieces. Columns
other than the two named are not read, so their names cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import release, tidy
from shopmart.llm.tokens import encode_batches, text_encoder

PIECES = (
    "{id} {type}, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary"
)


class _Piece:
    """Ids of a document, of ``total`` ids, from the ``start``-th on; ``ids`` are those from ``base`` on."""

    __slots__ = ("base", "ids", "key", "start", "stop", "total")

    def __init__(self, key, total: int, ids: bytes, base: int, start: int, stop: int) -> None:
        self.key, self.total, self.ids, self.base = key, total, ids, base
        self.start, self.stop = start, stop

    def __len__(self) -> int:
        return self.stop - self.start

    def data(self) -> bytes:
        return self.ids[4 * (self.start - self.base) : 4 * (self.stop - self.base)]

    def cut(self, n: int) -> _Piece:
        """The first n ids, as a piece of their own; the others remain."""
        head = _Piece(self.key, self.total, self.ids, self.base, self.start, self.start + n)
        self.start += n
        return head

    def alone(self) -> _Piece:
        """The same piece, without the memory of its document."""
        return _Piece(self.key, self.total, self.data(), self.start, self.start, self.stop)


class _Bins:
    """The bins of one task; ``full`` has the rows of closed sequences."""

    def __init__(self, size: int, task: int, with_ids: bool) -> None:
        self.size, self.with_ids = size, with_ids
        self.next_id = task << 40
        self.open: dict[int, list[_Piece]] = {}
        self.waiting: list[list[_Piece]] = []  # bins that are not quite full
        self.filler: _Piece | None = None
        self.full: list[tuple] = []

    def add(self, document: _Piece) -> None:
        while len(document) >= self.size:
            self._close([document.cut(self.size)])
        if not len(document):
            return
        document = document.alone()
        if self.waiting and self.filler is None:
            self.filler = document
            self._fill()
            return
        k = self.size // len(document)
        held = self.open.setdefault(k, [])
        held.append(document)
        if len(held) == k:
            del self.open[k]
            self.waiting.append(held)
            self._fill()

    def _fill(self) -> None:
        """Close waiting bins as far as the filler reaches."""
        while self.waiting:
            held = self.waiting[-1]
            left = self.size - sum(map(len, held))
            if left and self.filler is None:
                return
            if left:
                held.append(self.filler.cut(min(left, len(self.filler))))
                if not len(self.filler):
                    self.filler = None
            if sum(map(len, held)) == self.size:
                self._close(self.waiting.pop())

    def _close(self, pieces: list[_Piece]) -> None:
        offset = 0
        for p in pieces:
            data = p.data()
            held = data if self.with_ids else None
            row = (p.key, p.start, len(p), zlib.crc32(data), p.total, self.next_id, offset, held)
            self.full.append(row)
            offset += len(p)
        self.next_id += 1

    def finish(self) -> None:
        """Close what is open: whole sequences, then powers of two."""
        rest = [p for held in self.waiting for p in held]
        rest += [p for _, held in sorted(self.open.items()) for p in held]
        rest += [self.filler] if self.filler else []
        total = sum(map(len, rest))
        sizes = [self.size] * (total // self.size)
        left = total % self.size
        sizes += [1 << k for k in range(left.bit_length() - 1, -1, -1) if left >> k & 1]
        rest.reverse()
        for size in sizes:
            pieces: list[_Piece] = []
            while size:
                own = rest[-1].cut(min(size, len(rest[-1])))
                if not len(rest[-1]):
                    rest.pop()
                size -= len(own)
                pieces.append(own)
            self._close(pieces)


def pack(
    docs: DataFrame,
    tokenizer: str,
    size: int = 1024,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: where it is in its document and in which sequence.

    ``size`` is a power of two. ``ids`` holds the piece's ids as little-endian
    unsigned 32-bit numbers, or is null without ``with_ids``.
    """
    if size < 1 or size & (size - 1):
        raise ValueError(f"size must be a power of two, not {size}")
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer)
        bins = _Bins(size, TaskContext.get().partitionId(), with_ids)
        id_type = None

        def rows() -> pa.RecordBatch:
            columns = list(zip(*bins.full, strict=True)) or [[]] * 8
            bins.full = []
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], id_type),
                    *(pa.array(c, pa.int64()) for c in columns[1:7]),
                    pa.array(columns[7], pa.binary()),
                ],
                [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
            )

        for part in encode_batches(batches):
            id_type = part.schema.field("id").type
            ids, counts = encoder.encode(part.column("text"))
            stops = np.cumsum(counts).tolist()
            for key, n, stop in zip(part.column("id").to_pylist(), counts.tolist(), stops, strict=True):
                own = ids[stop - n : stop].astype("<u4").tobytes() + end
                bins.add(_Piece(key, n + 1, own, 0, 0, n + 1))
            yield rows()
            release()
        if id_type is not None:
            bins.finish()
            yield rows()

    return source.mapInArrow(tidy(run), PIECES.format(id=f"`{id_col}`", type=kind))


def sequences(pieces: DataFrame) -> DataFrame:
    """The sequences that ``pack`` made, each with its pieces' ids one after another.

    A group has at most ``size`` pieces. ``starts`` has the offset of each piece.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (
        pieces.groupBy("sequence_id")
        .agg(F.sum("length").alias("length"), ordered.alias("parts"))
        .select(
            "sequence_id",
            "length",
            F.col("parts.offset").alias("starts"),
            F.expr("unhex(array_join(transform(parts, p -> hex(p.ids)), ''))").alias("ids"),
        )
    )
