"""Token files: frequency-ranked ids in byte-aligned variable-length coding.

A folder holds ``ranks.bin`` (the id of each rank, most frequent first, ties to
the smaller id), one file per task in ascending document order, and
``manifest.json`` with the files and the number of ids before each. A file is
a run of blocks; a block has whole documents:

    8 numbers, little-endian unsigned 64-bit: magic, documents, ids,
    flags of null document ids (bytes), control bytes, data bytes, bytes of the
    compressed body, crc32 of the body
    body (zstd): document ids (64-bit), null flags, ids of each document (64-bit),
    control bytes, data bytes

A control byte holds the lengths of four values, two bits each, apart from the
data, which are 1 to 4 bytes little-endian per value. Decoding looks the lengths up in
a table of 256 rows and gathers the bytes with numpy.

Nulls: a null text is an empty document (its end id alone); a null document id
comes first. Repeated ids are in the order of their texts' ids. An empty table
gives a folder without files. Other columns are not read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.llm.common import new_folder, open_folder, release, stored, tidy
from shopmart.llm.tokens import encode_batches, text_encoder

MAGIC = 0x314B4E4152545246
BLOCK_IDS = 1 << 20
FILE_IDS = 1 << 25

# Lengths of the four values that a control byte describes.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.int64)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = values.astype("<u4")
    lengths = 1 + (values > 0xFF) + (values > 0xFFFF) + (values > 0xFFFFFF).astype(np.int64)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = lengths - 1
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    kept = np.arange(4) < lengths[:, None]
    return control.astype(np.uint8).tobytes(), values.view(np.uint8).reshape(-1, 4)[kept].tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of control and data bytes."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    begins = np.cumsum(lengths) - lengths
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    values = np.zeros(n, np.uint32)
    for k in range(int(lengths.max(initial=0))):
        part = raw[begins + k].astype(np.uint32) << 8 * k
        values |= np.where(lengths > k, part, 0).astype(np.uint32)
    return values


def _block(keys: list, counts: list[int], ranks: np.ndarray) -> bytes:
    control, data = encode_values(ranks)
    nulls = np.array([k is None for k in keys], np.uint8).tobytes()
    body = b"".join(
        [
            np.array([k or 0 for k in keys], "<i8").tobytes(),
            nulls,
            np.array(counts, "<i8").tobytes(),
            control,
            data,
        ]
    )
    packed = zstandard.compress(body, 1)
    head = [MAGIC, len(keys), len(ranks), len(nulls), len(control), len(data), len(packed)]
    return np.array([*head, zlib.crc32(packed)], "<u8").tobytes() + packed


def _blocks(stream) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Document ids, counts and ranks of each block of a file."""
    while head := stream.read(64):
        magic, docs, n, nulls, control, data, size, crc = np.frombuffer(head, "<u8").tolist()
        packed = stream.read(size)
        if magic != MAGIC or zlib.crc32(packed) != crc:
            raise ValueError("damaged token file")
        body = zstandard.decompress(packed)
        at = np.cumsum([0, 8 * docs, nulls, 8 * docs, control, data]).tolist()
        keys, flags, counts, c, d = (body[a:b] for a, b in zip(at, at[1:], strict=False))
        numbers = np.frombuffer(keys, "<i8").tolist()
        ids = [None if f else k for k, f in zip(numbers, flags, strict=True)]
        yield ids, np.frombuffer(counts, "<i8"), decode_values(c, d, n)


def _tokenised(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str):
    """A row per document with its ids (compressed), and rows with counts per id."""
    source = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer)
        size = max(encoder.n_vocab, end_id + 1)
        kind = np.uint16 if size <= 1 << 16 else np.uint32
        seen = np.zeros(size, np.int64)
        compressor = zstandard.ZstdCompressor(3)
        end = np.array([end_id], kind)
        names = ["is_count", "id", "n", "ids"]

        def rows(is_count, ids, ns, blobs):
            columns = [pa.array([is_count] * len(ns)), pa.array(ids, pa.int64()), pa.array(ns, pa.int64())]
            return pa.RecordBatch.from_arrays([*columns, pa.array(blobs, pa.binary())], names)

        for part in encode_batches(batches):
            ids, counts = encoder.encode(part.column("text"))
            seen += np.bincount(ids, minlength=size)
            seen[end_id] += len(counts)
            stops = np.cumsum(counts).tolist()
            small, ns = ids.astype(kind), counts.tolist()
            blobs = [
                compressor.compress(np.concatenate([small[s - n : s], end]).tobytes())
                for s, n in zip(stops, ns, strict=True)
            ]
            yield rows(False, part.column("id").to_pylist(), [n + 1 for n in ns], blobs)
            release()
        used = np.flatnonzero(seen)
        yield rows(True, used.tolist(), seen[used].tolist(), [None] * len(used))

    return source.mapInArrow(tidy(run), "is_count boolean, id long, n long, ids binary")


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_ids: int = FILE_IDS,
) -> str:
    """Write all documents' ids to ``folder`` in ascending order of ``id_col``; the folder.

    Texts are encoded once, to a table in the shared folder. What reaches the
    driver is one number per id of the vocabulary and one row per file.
    """
    spark = docs.sparkSession
    found = stored(
        _tokenised(docs, tokenizer, end_id, id_col, text_col), "tokenised", ["is_count"]
    )
    counted = found.where("is_count").groupBy("id").agg(F.sum("n").alias("n"))
    ranked = [r.id for r in counted.orderBy(F.desc("n"), "id").collect()]
    total = counted.agg(F.sum("n")).first()[0] or 0
    rank_of = np.zeros(max(ranked, default=0) + 1, np.uint32)
    rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)
    narrow = max(text_encoder(tokenizer).n_vocab, end_id + 1) <= 1 << 16
    kind = "<u2" if narrow else "<u4"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)
        task = TaskContext.get().partitionId()
        # A repeated task writes a file of its own; the manifest names one of them.
        name = f"part-{task:06d}-{uuid.uuid4().hex}.tok"
        n_docs = n_ids = 0
        decompressor = zstandard.ZstdDecompressor()
        stream, keys, counts, held = None, [], [], []

        def flush() -> None:
            nonlocal stream, keys, counts, held
            stream = stream or files.open_output_stream(f"{base}/{name}")
            stream.write(_block(keys, counts, rank_of[np.concatenate(held)]))
            keys, counts, held = [], [], []

        for batch in batches:
            for key, n, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if keys and sum(counts) + n > BLOCK_IDS:
                    flush()
                keys.append(key)
                counts.append(n)
                held.append(np.frombuffer(decompressor.decompress(blob), kind))
                n_docs, n_ids = n_docs + 1, n_ids + n
        if keys:
            flush()
        if stream:
            stream.close()
            values = {"task": [task], "file": [name], "n_docs": [n_docs], "n_ids": [n_ids]}
            yield pa.RecordBatch.from_pydict(values)

    files, base = open_folder(folder)
    files.create_dir(base, recursive=True)
    n_files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // file_ids))
    ordered = (
        found.where("not is_count")
        .select("id", "n", "ids")
        .repartitionByRange(n_files, "id")
        .sortWithinPartitions("id", "n", "ids")
    )
    parts = ordered.mapInArrow(write, "task long, file string, n_docs long, n_ids long").collect()
    manifest, before = [], 0
    for row in sorted(parts):
        manifest.append(row.asDict() | {"ids_before": before})
        before += row.n_ids
    with files.open_output_stream(f"{base}/ranks.bin") as out:
        out.write(np.array(ranked, "<u4").tobytes())
    with files.open_output_stream(f"{base}/manifest.json") as out:
        out.write(json.dumps({"end_id": end_id, "files": manifest}).encode())
    return folder


def read_tokens(
    spark: SparkSession, folder: str, id_col: str = "doc_id", with_ids: bool = True
) -> DataFrame:
    """A row per document of a folder: ``start`` (ids before it), ``n_tokens``,
    ``ids_crc32`` and ``ids`` (little-endian unsigned 32-bit; null without ``with_ids``)."""
    files, base = open_folder(folder)
    with files.open_input_stream(f"{base}/manifest.json") as source:
        listed = json.loads(source.read())["files"]
    schema = f"`{id_col}` long, start long, n_tokens long, ids_crc32 long, ids binary"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)
        id_of = None
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if id_of is None:
                    with files.open_input_stream(f"{base}/ranks.bin") as source:
                        id_of = np.frombuffer(source.read(), "<u4")
                with files.open_input_stream(f"{base}/{name}") as source:
                    for keys, counts, ranks in _blocks(source):
                        data = id_of[ranks].tobytes()
                        stops = np.cumsum(counts)
                        begins = (stops - counts).tolist()
                        own = [data[4 * a : 4 * b] for a, b in zip(begins, stops.tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(keys, pa.int64()),
                                pa.array((start + stops - counts).tolist(), pa.int64()),
                                pa.array(counts.tolist(), pa.int64()),
                                pa.array(list(map(zlib.crc32, own)), pa.int64()),
                                pa.array(own if with_ids else [None] * len(own), pa.binary()),
                            ],
                            [id_col, "start", "n_tokens", "ids_crc32", "ids"],
                        )
                        start += len(ranks)

    rows = [(x["file"], x["ids_before"]) for x in listed]
    source = spark.createDataFrame(rows, "file string, ids_before long")
    return source.repartition(max(1, len(rows))).mapInArrow(read, schema)


def token_folder(spark: SparkSession) -> str:
    return new_folder(spark, "token-files")
